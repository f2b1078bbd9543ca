"""Scalar text columns.

Every function takes and returns a ``Column`` and stays inside Catalyst (no UDF).
Each has a ``sql_*`` twin that writes the same expression as DuckDB SQL text;
the oracle queries are built from those twins so both sides share one rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white-space class that matches Python's ``str.strip()`` in
# both Java regex and RE2 (``\s`` alone misses \x0B, \x1C-\x1F, \x85 and the
# Unicode separators).
WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
# the same characters as a list: taken off the ends, they cost a look at the ends and not a pattern tried at every place
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
STRIP_RE = rf"^{WS}+|{WS}+$"
BLANK_RE = rf"^{WS}*$"

# File-name sanitising.  '/', '\' and ':' become '-'; '?', '*',
# '"', '<', '>' and '|' are dropped; names are cut at 200 characters.
NAME_DASHED = "/\\:"
NAME_DROPPED = '?*"<>|'
NAME_MAX = 200

# The markers that delimit a model response.
MODEL_MARK = "\nmodel\n"
TURN_MODEL_MARK = "<start_of_turn>model"
END_TURN = "<end_of_turn>"

# Greedy first '{' to last '}' across lines.  Written with (?s) instead of
# (.|\n)* so that Java does not recurse once per character.
OUTER_OBJECT_RE = r"(?s)\{.*\}"
# Greedy reasoning block: first <think> to the last </think> that is followed
# by a blank line.
REASONING_RE = r"(?s)<think>.*</think>\n\n"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sql_str(s: str) -> str:
    """A DuckDB string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_text(s: str) -> str:
    """A DuckDB string literal that may carry newlines (via chr(10))."""
    parts = s.split("\n")
    return " || chr(10) || ".join(sql_str(p) for p in parts) if len(parts) > 1 else sql_str(s)


# --- C3 py_strip ----------------------------------------------------------------

def py_strip(col) -> Column:
    """Python ``str.strip()``: Unicode white space off both ends."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def sql_py_strip(e: str) -> str:
    return f"regexp_replace({e}, {sql_str(STRIP_RE)}, '', 'g')"


def is_blank(col) -> Column:
    """True when nothing but white space is left (``len(s.strip()) == 0``)."""
    return py_strip(col) == ""


def sql_is_blank(e: str) -> str:
    return f"regexp_matches({e}, {sql_str(BLANK_RE)})"


# --- C1 safe_name ---------------------------------------------------------------

def safe_name(col) -> Column:
    """File-system safe name: separators to '-', reserved characters dropped, 200 max."""
    return F.left(F.translate(_c(col), NAME_DASHED + NAME_DROPPED, "---"), F.lit(NAME_MAX))


def sql_safe_name(e: str) -> str:
    return f"left(translate({e}, {sql_str(NAME_DASHED + NAME_DROPPED)}, '---'), {NAME_MAX})"


# --- C2 human_time --------------------------------------------------------------

def human_time(col) -> Column:
    """Seconds as ``12.3s`` / ``4.5m`` / ``1.2h``.

    One decimal, rounded half-up on the decimal value (a documented divergence
    from Python's binary round-half-even at exact ties such as 0.25).
    """
    s = _c(col).cast("double")

    def one(v: Column) -> Column:
        d = F.round(v.cast("decimal(38,9)"), 1).cast("decimal(38,1)")
        return d.cast("string")

    return (F.when(s < 60, F.concat(one(s), F.lit("s")))
            .when(s < 3600, F.concat(one(s / 60), F.lit("m")))
            .otherwise(F.concat(one(s / 3600), F.lit("h"))))


def sql_human_time(e: str) -> str:
    def one(v: str) -> str:
        return f"cast(cast(round(cast({v} AS DECIMAL(38,9)), 1) AS DECIMAL(38,1)) AS VARCHAR)"
    s = f"cast({e} AS DOUBLE)"
    return (f"CASE WHEN {s} < 60 THEN {one(s)} || 's' "
            f"WHEN {s} < 3600 THEN {one(f'({s} / 60)')} || 'm' "
            f"ELSE {one(f'({s} / 3600)')} || 'h' END")


# --- C4 response_tail -----------------------------------------------------------

def response_tail(col) -> Column:
    """Model answer out of a decoded generation: text after the last ``\\nmodel\\n``,
    else after the last ``<start_of_turn>model``, else everything; turn ends removed."""
    c = _c(col)
    tail = (F.when(c.contains(MODEL_MARK), py_strip(F.substring_index(c, MODEL_MARK, -1)))
            .when(c.contains(TURN_MODEL_MARK), py_strip(F.substring_index(c, TURN_MODEL_MARK, -1)))
            .otherwise(c))
    return py_strip(F.replace(tail, F.lit(END_TURN), F.lit("")))


def sql_response_tail(e: str) -> str:
    m1, m2 = sql_text(MODEL_MARK), sql_str(TURN_MODEL_MARK)
    tail = (f"CASE WHEN contains({e}, {m1}) THEN {sql_py_strip(f'string_split({e}, {m1})[-1]')} "
            f"WHEN contains({e}, {m2}) THEN {sql_py_strip(f'string_split({e}, {m2})[-1]')} "
            f"ELSE {e} END")
    return sql_py_strip(f"replace({tail}, {sql_str(END_TURN)}, '')")


# --- C5 outer_json --------------------------------------------------------------

def outer_json(col) -> Column:
    """Greedy first '{' to last '}'; the text itself when there is no such span."""
    c = _c(col)
    found = F.regexp_extract(c, OUTER_OBJECT_RE, 0)
    return F.when(found == "", c).otherwise(found)


def sql_outer_json(e: str) -> str:
    found = f"regexp_extract({e}, {sql_str(OUTER_OBJECT_RE)}, 0)"
    return f"CASE WHEN {found} = '' THEN {e} ELSE {found} END"


def extract_answer_json(col) -> Column:
    """C4 then C5: the JSON part of a generated answer."""
    return outer_json(response_tail(col))


def sql_extract_answer_json(e: str) -> str:
    return sql_outer_json(sql_response_tail(e))


# --- C6 fenced_json -------------------------------------------------------------

FENCE = "```"
JSON_FENCE = "```json"
NO_JSON_ERROR = "Could not extract JSON from response"


def fenced_json(col) -> Column:
    """JSON inside a reply: a ```json fence, else any fence, else first '{' to last '}'.

    Returns NULL when none applies (the caller records ``NO_JSON_ERROR``).  An
    unclosed fence takes the rest of the text.
    """
    c = _c(col)
    after_json = F.substring(c, F.instr(c, JSON_FENCE) + len(JSON_FENCE), 1 << 30)
    after_any = F.substring(c, F.instr(c, FENCE) + len(FENCE), 1 << 30)
    brace = F.regexp_extract(c, OUTER_OBJECT_RE, 0)
    return (F.when(c.contains(JSON_FENCE), py_strip(F.substring_index(after_json, FENCE, 1)))
            .when(c.contains(FENCE), py_strip(F.substring_index(after_any, FENCE, 1)))
            .when(brace != "", brace))


def sql_fenced_json(e: str) -> str:
    after_json = f"substr({e}, instr({e}, {sql_str(JSON_FENCE)}) + {len(JSON_FENCE)})"
    after_any = f"substr({e}, instr({e}, {sql_str(FENCE)}) + {len(FENCE)})"
    brace = f"regexp_extract({e}, {sql_str(OUTER_OBJECT_RE)}, 0)"
    return (f"CASE WHEN contains({e}, {sql_str(JSON_FENCE)}) THEN {sql_py_strip(f'split_part({after_json}, {sql_str(FENCE)}, 1)')} "
            f"WHEN contains({e}, {sql_str(FENCE)}) THEN {sql_py_strip(f'split_part({after_any}, {sql_str(FENCE)}, 1)')} "
            f"WHEN {brace} <> '' THEN {brace} END")


# --- B8 strip_reasoning -----------------------------------------------------------

def strip_reasoning(col) -> Column:
    """Remove the greedy ``<think> ... </think>\\n\\n`` block."""
    return F.regexp_replace(_c(col), REASONING_RE, "")


def sql_strip_reasoning(e: str) -> str:
    return f"regexp_replace({e}, {sql_str(REASONING_RE)}, '', 'g')"


# --- B13 preview ----------------------------------------------------------------

def preview(col, n: int = 200) -> Column:
    """First ``n`` characters plus ``...`` when the text is longer."""
    c = _c(col)
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def sql_preview(e: str, n: int = 200) -> str:
    return f"CASE WHEN length({e}) > {n} THEN left({e}, {n}) || '...' ELSE {e} END"


# --- C12 pct --------------------------------------------------------------------

def pct(num, den) -> Column:
    """``num * 100 / den`` as DOUBLE, 0 when the denominator is 0."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d > 0, F.round(n * 100.0 / d, 6)).otherwise(F.lit(0.0))


def sql_pct(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN round(cast({num} AS DOUBLE) * 100.0 / cast({den} AS DOUBLE), 6) ELSE 0.0 END"


# --- md5 bucket (shared by sampling, splits and synthesis) --------------------------

def md5_number(col) -> Column:
    """First 32 bits of md5(text) as BIGINT: a seedable, partition-independent hash."""
    return F.conv(F.substring(F.md5(_c(col)), 1, 8), 16, 10).cast("bigint")


def sql_md5_number(e: str) -> str:
    return f"cast(('0x' || substr(md5({e}), 1, 8)) AS BIGINT)"
