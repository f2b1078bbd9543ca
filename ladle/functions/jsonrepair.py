"""Token repair of JSON-like text (C7): the rungs behind the plain repair ladder.

The text is read as a row of tokens, by one pattern, and each token is written anew from itself and its
two neighbours, so the work is linear in the text:

* strings in single or curly quotes become JSON strings; quotes inside a string that no comma, colon,
  bracket or further string follows are content and get escaped, and so are raw line breaks;
* bare keys and bare words are quoted; numbers stay; Python's and JavaScript's literals become JSON's;
* comments go; commas missing between two values are put in, doubled, leading and trailing ones go; a
  key without a value gets null;
* a string cut off at the end of the text is closed (open brackets are left to the ladder).

Brackets are never added, dropped or changed here, so mismatched ones stay rejected.

A run of tokens that need no change (brackets, keys and plain strings in quotes of one kind, without white space
between them) is read as one token, so that only what is damaged is worked on token by token.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literals of JSON and how other languages write them.
LITERALS = {"true": ["true", "True", "TRUE"], "false": ["false", "False", "FALSE"], "null": ["null", "None", "NULL", "undefined"]}
# Numbers that JSON cannot write; texts with them stay rejected.
NOT_JSON = ["NaN", "Infinity", "-Infinity"]
NUMBER_RE = r"-?(?:0|[1-9]\d*+)(?:\.\d++)?(?:[eE][+-]?\d++)?"

_COMMENT = r"//[^\n]*+|#[^\n]*+|/\*[^*]*+(?:\*(?!/)[^*]*+)*+(?:\*/|\z)"
# what may follow a comma that ends a value
_NEXT = rf"(?:[\"'“{{}}\[\],]|-?\d|\z|//|/\*|#|[A-Za-z_$@][\w$@-]*+\s*+:|(?:{'|'.join(w for words in LITERALS.values() for w in words)})\b)"
# a further string: its comma is missing
_FURTHER = r"[\"'“][^\"'“”\\]*+[\"'”]\s*+[:,}\]\"'“]"
_CLOSES = rf"\s*+(?:[:}}\]]|\z|,\s*+{_NEXT}|{_FURTHER})"


def _string(q: str) -> str:
    return rf"{q}(?:[^{q}\\]++|\\(?s:.)|\\\z|{q}(?!{_CLOSES}))*+(?:{q}|\z)"


# characters that a plain string in quotes of a kind has none of, one by one: Java tests such a list in one look-up
_NO_CONTROL = "".join(rf"\x{i:02x}" for i in range(0x20))
_PLAIN_IN = {'"': rf'"[^"\\{_NO_CONTROL}]*+"', "'": rf"'[^'\"\\{_NO_CONTROL}]*+'"}


def _run(q: str) -> str:
    """Tokens of which each two side by side stay as they are: strings in ``q`` with neither quotes nor escapes, and brackets."""
    plain, value = _PLAIN_IN[q], rf"(?=[{q}{{\[])"
    return rf"(?:{plain}(?::{value}|,{value}|(?=[}}\]]))|[{{\[](?=[{q}{{}}\[\]])|[}}\]](?:,{value}|(?=[}}\]])))++"


SINGLE_TOKEN_RE = "|".join([r"\s++", _COMMENT, _string('"'), _string("'"), r"“[^”]*+(?:”|\z)", r"[{}\[\],:]",
                            rf"{NUMBER_RE}(?=\s*+(?:[,:}}\]\[\"'“{{]|\z|//|/\*|#)|\s++-?\d)", r"[^\s\"'“{}\[\],:][^\"“{}\[\],:\n]*+", r"(?s:.)"])
TOKEN_RE = "|".join([_run(q) for q in _PLAIN_IN] + [SINGLE_TOKEN_RE])
SKIPPED_RE = r"\A(?:\s|//|#|/\*)"
_ODD_BACKSLASH = r"(?<!\\)((?:\\\\)*+)\\"
# a plain string, or a run that starts with one (in a single string token no closing quote stands before these)
_PLAIN = r"\A(?:" + "|".join(rf"{_PLAIN_IN[q]}(?:\z|[:}}\]]|,(?:\z|[{q}{{\[]))" for q in _PLAIN_IN) + ")"
_CONTROL = {"\n": r"\n", "\r": r"\r", "\t": r"\t"}


def _quoted(content: Column) -> Column:
    """A JSON string of a string's raw content: escapes kept, whatever else must be escaped is."""
    out = F.regexp_replace(content, _ODD_BACKSLASH + r'(?!["\\/bfnrtu])', "$1")  # unknown escapes
    out = F.regexp_replace(out, r'(?<!\\)((?:\\\\)*+)"', r'$1\\"')
    for raw, escaped in _CONTROL.items():
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), F.regexp_replace(out, r"[\x00-\x1f]", " "), F.lit('"'))


def _written(token: Column, is_key: Column) -> Column:
    """One token as JSON, whatever stands beside it."""
    head, size = F.left(token, F.lit(1)), F.length(token)
    closed = (size > 1) & F.rlike(token, F.lit(r"""(?:(?<!\\)(?:\\\\)*+["']|”)\z"""))
    content = F.regexp_replace(F.substring(token, F.lit(2), size - F.when(closed, 2).otherwise(1)), _ODD_BACKSLASH + r"\z", "$1")
    single = _quoted(F.regexp_replace(content, _ODD_BACKSLASH + "'", "$1'"))
    word = F.rtrim(F.regexp_replace(token, r"\s+\z", ""))
    bare = F.concat(F.lit('"'), F.regexp_replace(word, r"\\", r"\\\\"), F.lit('"'))
    literal = F.coalesce(*[F.when(word.isin(words), F.lit(literal)) for literal, words in LITERALS.items()])
    # a run in single quotes holds no double ones
    whole = F.when(F.contains(token, F.lit('"')), token).otherwise(F.translate(token, "'", '"'))
    return (F.when(head.isin("{", "}", "[", "]", ",", ":") | F.rlike(token, F.lit(_PLAIN)), whole)
            .when(head == '"', _quoted(content)).when(head.isin("'", "“"), single)
            .when(is_key, bare)
            .when(F.rlike(word, F.lit(rf"\A{NUMBER_RE}\z")) | word.isin(NOT_JSON), word)
            .otherwise(F.coalesce(literal, bare)))


def repair_tokens(text: Column) -> Column:
    """The text with every token written as JSON, without white space; NULL stays NULL."""
    tokens = F.filter(F.regexp_extract_all(text, F.lit(TOKEN_RE), F.lit(0)), lambda t: ~F.rlike(t, F.lit(SKIPPED_RE)))

    def written(all_tokens: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            # of the neighbours, only the character that stands beside the token counts
            before = F.coalesce(F.right(F.get(all_tokens, i - 1), F.lit(1)), F.lit(""))
            after = F.coalesce(F.left(F.get(all_tokens, i + 1), F.lit(1)), F.lit(""))
            value_ends = ~before.isin("", "{", "[", ",", ":")
            value_starts = ~F.left(token, F.lit(1)).isin("}", "]", ",", ":")
            comma = F.when(value_ends & value_starts, ",").otherwise("")
            spare = (token == ",") & (after.isin(",", "}", "]") | before.isin("{", "["))
            empty = F.when((token == ":") & after.isin(",", "}", "]"), "null").otherwise("")
            return F.when(spare, "").otherwise(F.concat(comma, _written(token, after == ":"), empty))
        return F.array_join(F.transform(all_tokens, one), "")
    # a list of one list, so that the tokens are found once and not again for each of them
    return F.get(F.transform(F.array(tokens), written), 0)
