"""JSON document columns.

Parsed documents are Spark ``VARIANT`` values.  A variant re-sorts object keys,
so output text is always the source text; the variant is only used for checks.

The SQL twins (``sql_*``) express the same rules with DuckDB's JSON functions
over text, for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.functions.jsonrepair import repair_tokens
from ladle.functions.text import (
    FENCE, JSON_FENCE, _c, outer_json, py_strip, sql_py_strip, sql_str,
)

# A JSON string literal (with escapes), used to blank out strings before looking at brackets
# and commas.  Possessive, so that Java neither recurses per character nor backtracks.
STRING_LIT_RE = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# the same for RE2, which has no possessive forms and never backtracks
SQL_STRING_LIT_RE = r'(?s)"(?:[^"\\]|\\.)*"'
TRAILING_COMMA_RE = r",(\s*[}\]])"
NON_BRACKET_RE = r"[^\[\]{}]"
# what stands between two brackets, strings included, as one match
BETWEEN_BRACKETS_RE = rf'(?:{STRING_LIT_RE}|[^\[\]{{}}"]++)++'
# an opener with its closer, and pairs in it, two deep
CLOSED_RE = r"[\[{](?:[\[{](?:[\[{][\]}])*+[\]}])*+[\]}]"
BARE_TOKEN_RE = r"(^|[^A-Za-z0-9_])(NaN|-?Infinity)([^A-Za-z0-9_]|$)"
ESCAPE_RE = r"(?s)\\."

# --- strict parse ---------------------------------------------------------------

def _wrapped(c: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), c, F.lit("\n]")))


def _single(w: Column) -> Column:
    # exactly one element: $[0] present and no $[1]
    return F.when(F.variant_get(w, "$[1]", "variant").isNull(), F.variant_get(w, "$[0]", "variant"))


def parse_strict(col) -> Column:
    """VARIANT of the text when the *whole* text is one JSON value, else NULL.

    ``try_parse_json`` alone accepts trailing text (``{"a":1} x``); wrapping the
    text in ``[ ]`` makes the parser consume all of it, and the single element is
    taken back out.  JSON null is kept as a variant null.
    """
    # a list of one, so that the text is parsed once
    return F.get(F.transform(F.array(_wrapped(_c(col))), _single), 0)


def sql_parse_ok(e: str) -> str:
    """DuckDB side of ``parse_strict(..) IS NOT NULL``: yyjson accepts trailing
    commas and NaN, which Jackson does not, so those are ruled out explicitly."""
    blanked = f"regexp_replace({e}, {sql_str(SQL_STRING_LIT_RE)}, '\"\"', 'g')"
    return (f"(coalesce(json_valid({e}), false) "
            f"AND NOT regexp_matches({blanked}, {sql_str(TRAILING_COMMA_RE)}) "
            f"AND NOT regexp_matches({blanked}, {sql_str(BARE_TOKEN_RE)}))")


# --- C7 repair ladder -----------------------------------------------------------

def _fence_cut(c: Column) -> Column:
    after_json = F.substring(c, F.instr(c, JSON_FENCE) + len(JSON_FENCE), 1 << 30)
    after_any = F.substring(c, F.instr(c, FENCE) + len(FENCE), 1 << 30)
    return (F.when(c.contains(JSON_FENCE), py_strip(F.substring_index(after_json, FENCE, 1)))
            .when(c.contains(FENCE), py_strip(F.substring_index(after_any, FENCE, 1)))
            .otherwise(c))


def _sql_fence_cut(e: str) -> str:
    after_json = f"substr({e}, instr({e}, {sql_str(JSON_FENCE)}) + {len(JSON_FENCE)})"
    after_any = f"substr({e}, instr({e}, {sql_str(FENCE)}) + {len(FENCE)})"
    return (f"CASE WHEN contains({e}, {sql_str(JSON_FENCE)}) THEN {sql_py_strip(f'split_part({after_json}, {sql_str(FENCE)}, 1)')} "
            f"WHEN contains({e}, {sql_str(FENCE)}) THEN {sql_py_strip(f'split_part({after_any}, {sql_str(FENCE)}, 1)')} "
            f"ELSE {e} END")


def _drop_trailing_commas(c: Column) -> Column:
    """Commas before a closing bracket go, unless they stand inside a string."""
    return F.when(F.rlike(c, F.lit(TRAILING_COMMA_RE)), F.regexp_replace(c, f"({STRING_LIT_RE})|{TRAILING_COMMA_RE}", "$1$2")).otherwise(c)


def _sql_drop_trailing_commas(e: str) -> str:
    return f"regexp_replace({e}, {sql_str(f'({SQL_STRING_LIT_RE})|{TRAILING_COMMA_RE}')}, '\\1\\2', 'g')"


def _from_first_brace(c: Column) -> Column:
    """The text from its first ``{``, to its end: nothing after the last ``}`` is lost."""
    at = F.instr(c, "{")
    return F.when(at > 0, F.substring(c, at, F.length(c)))


def _close_open(c: Column) -> Column:
    """Close an unterminated string, then all brackets left open, innermost first.

    One pass over the brackets from the right: a closer waits for its opener, and an opener
    that no closer waits for is still open.  Any depth; NULL if a closer has no opener.
    """
    bare = F.regexp_replace(c, ESCAPE_RE, "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    s = F.when(quotes % 2 == 1, F.concat(F.regexp_replace(c, r"(?<!\\)((?:\\\\)*+)\\\z", "$1"), F.lit('"'))).otherwise(c)
    brackets = F.regexp_replace(F.regexp_replace(s, BETWEEN_BRACKETS_RE, ""), NON_BRACKET_RE, "")
    # closed pairs change nothing in the pass
    brackets = F.reverse(F.regexp_replace(brackets, CLOSED_RE, ""))
    start = F.struct(F.lit(0).alias("waiting"), F.lit("").alias("closers"))

    def step(acc, b):
        closer = b.isin("}", "]")
        waiting = acc["waiting"] + F.when(closer, 1).when(acc["waiting"] > 0, -1).otherwise(0)
        still_open = ~closer & (acc["waiting"] == 0)
        return F.struct(waiting.alias("waiting"), F.when(still_open, F.concat(acc["closers"], F.translate(b, "{[", "}]")))
                        .otherwise(acc["closers"]).alias("closers"))
    found = F.aggregate(F.split(brackets, ""), start, step, lambda acc: F.when(acc["waiting"] == 0, acc["closers"]))
    return _drop_trailing_commas(F.concat(s, found))


def sql_close_open_ctes(src: str, text: str, out: str) -> list[tuple[str, str]]:
    """The same rung as DuckDB CTEs (``out`` = ``src`` plus t4), by another rule: depths are running
    sums, and an opener is open if no depth after it falls below its own."""
    escape, literal, other = sql_str(ESCAPE_RE), sql_str(SQL_STRING_LIT_RE), sql_str(NON_BRACKET_RE)
    cut = f"CASE WHEN strpos({text}, '{{') > 0 THEN substr({text}, strpos({text}, '{{')) END"
    quotes = f"length(regexp_replace(regexp_replace(b1, {escape}, '', 'g'), '[^\"]', '', 'g'))"
    whole = "CASE WHEN length(regexp_extract(b1, '\\\\*$')) % 2 = 1 THEN substr(b1, 1, length(b1) - 1) ELSE b1 END"
    brackets = f"string_split(regexp_replace(regexp_replace(b2, {literal}, '', 'g'), {other}, '', 'g'), '')"
    return [
        (f"{out}_from", f"SELECT *, {cut} AS b1 FROM {src}"),
        (f"{out}_str", f"SELECT *, CASE WHEN {quotes} % 2 = 1 THEN ({whole}) || '\"' ELSE b1 END AS b2 FROM {out}_from"),
        (f"{out}_br", f"SELECT *, {brackets} AS br FROM {out}_str"),
        (f"{out}_step", "SELECT *, list_transform(br, lambda x: CASE WHEN x IN ('{', '[') THEN 1 WHEN x IN ('}', ']') THEN -1 ELSE 0 END) AS st "
                        f"FROM {out}_br"),
        (f"{out}_deep", f"SELECT *, list_transform(range(1, len(st) + 1), lambda i: list_sum(st[1:i])) AS dp FROM {out}_step"),
        (f"{out}_open", "SELECT *, list_filter(range(1, len(st) + 1), lambda i: st[i] = 1 AND list_min(dp[i:]) >= dp[i]) AS op "
                        f"FROM {out}_deep"),
        (out, "SELECT * EXCLUDE (b1, b2, br, st, dp, op), CASE WHEN list_min(dp) >= 0 THEN "
              + _sql_drop_trailing_commas("(b2 || array_to_string(list_reverse(list_transform(op, lambda i: translate(br[i], '{[', '}]'))), ''))")
              + f" END AS t4 FROM {out}_open"),
    ]


def candidates(col) -> list[Column]:
    """The repair ladder, in the order tried: as is; fence cut; outermost object; trailing commas
    dropped; open string / brackets closed (in the text from the first brace to its end); every
    token of the outermost object written as JSON; the same to the end of the text, brackets closed."""
    c0 = _c(col)
    c1 = _fence_cut(c0)
    c2 = outer_json(c1)
    c3 = _drop_trailing_commas(c2)
    c4 = _close_open(_from_first_brace(c1))
    c5 = repair_tokens(F.when(c2.startswith("{"), c2))
    c6 = _close_open(repair_tokens(_from_first_brace(c1)))
    return [c0, c1, c2, c3, c4, c5, c6]


def parse_tolerant(df, col: str, doc: str = "doc", outcome: str = "outcome", text: str = "json_text"):
    """Route each row to ``ok`` / ``repaired`` / ``rejected``.

    Adds ``doc`` (VARIANT, NULL when rejected), ``outcome`` and ``text`` (the text
    that parsed).  The first rung is parsed once for every row.  The repair
    rungs read a copy of the text that is NULL when the first rung succeeded,
    so clean rows skip all regex work; each rung and its parse is a column of
    its own, built from the previous rung, so no rung is repeated inside
    another and the generated code stays small.  A rung is worked out only if
    none before it parsed, and parsed only if its text is a new one: a failed
    parse costs more than a good one.
    """
    c0 = _c(col)
    # the parse of every row is a column of its own, which is compiled; a list's lambda is not
    out = df.withColumn("_lt_w", _wrapped(c0)).withColumn("_lt0", _single(F.col("_lt_w"))).withColumn("_lt_in", F.when(F.col("_lt0").isNull(), c0))
    # each rung reads the text of an earlier one: (rung, its input)
    steps = [(_fence_cut, "_lt_in"), (outer_json, "_lt_c1"), (_drop_trailing_commas, "_lt_c2"),
             (lambda c: _close_open(_from_first_brace(c)), "_lt_c1")]
    # token repair of an object only
    steps += [(lambda c: repair_tokens(F.when(c.startswith("{"), c)), "_lt_c2"),
              (lambda c: _close_open(repair_tokens(_from_first_brace(c))), "_lt_c1")]
    for i, (step, source) in enumerate(steps, start=1):
        open_yet = F.coalesce(F.lit(None), *[F.col(f"_lt_p{j}") for j in range(1, i)]).isNull()
        out = out.withColumn(f"_lt_c{i}", step(F.when(open_yet, F.col(source))))
        made = F.col(f"_lt_c{i}")
        tried = made.eqNullSafe(F.col("_lt_in"))
        for j in range(1, i):
            tried = tried | made.eqNullSafe(F.col(f"_lt_c{j}"))
        out = out.withColumn(f"_lt_p{i}", parse_strict(F.when(~tried, made)))
    rungs = [F.when(F.col("_lt0").isNotNull(), F.struct(F.col("_lt0").alias("d"), F.lit(0).alias("k"), c0.alias("s")))]
    rungs += [F.when(F.col(f"_lt_p{i}").isNotNull(), F.struct(F.col(f"_lt_p{i}").alias("d"), F.lit(i).alias("k"),
                                                            F.col(f"_lt_c{i}").alias("s"))) for i in range(1, len(steps) + 1)]
    out = out.withColumn("_lt", F.coalesce(*rungs))
    k = F.col("_lt.k")
    tmp = ["_lt", "_lt_w", "_lt0", "_lt_in"] + [f"_lt_{x}{i}" for i in range(1, len(steps) + 1) for x in ("c", "p")]
    return (out.withColumn(doc, F.col("_lt.d"))
               .withColumn(outcome, F.when(k == 0, "ok").when(k.isNotNull(), "repaired").otherwise("rejected"))
               .withColumn(text, F.col("_lt.s"))
               .drop(*tmp))


# --- C8 / C9 key state and kind -----------------------------------------------------

def path_of(key: str) -> str:
    """Variant path for a top-level key (bracket form works for '@type')."""
    return "$['" + key.replace("'", "\\'") + "']"


def sql_path_of(key: str) -> str:
    return '$."' + key + '"'


def get(doc, key: str) -> Column:
    """Value at ``key`` as VARIANT: SQL NULL when missing, variant null when JSON null."""
    return F.variant_get(_c(doc), path_of(key), "variant")


# Leading word of ``schema_of_variant`` to JSON kind; anything
# else (BIGINT, DECIMAL(p,s), DOUBLE, ...) is a number.
_KIND_OF_SCHEMA = {"STRING": "string", "VOID": "null", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"}


def kind(v) -> Column:
    """Run-time JSON type of a VARIANT value: string / number / boolean / null /
    array / object, or ``missing`` for SQL NULL.  One ``schema_of_variant`` call."""
    lookup = F.create_map(*[F.lit(x) for kv in _KIND_OF_SCHEMA.items() for x in kv])
    head = F.substring_index(F.schema_of_variant(_c(v)), "<", 1)
    return F.when(_c(v).isNull(), F.lit("missing")).otherwise(F.coalesce(lookup[head], F.lit("number")))


def sql_kind_of(json_type_expr: str) -> str:
    t = json_type_expr
    return (f"CASE WHEN {t} IS NULL THEN 'missing' WHEN {t} = 'VARCHAR' THEN 'string' "
            f"WHEN {t} = 'NULL' THEN 'null' WHEN {t} = 'BOOLEAN' THEN 'boolean' "
            f"WHEN {t} = 'ARRAY' THEN 'array' WHEN {t} = 'OBJECT' THEN 'object' ELSE 'number' END")


def sql_kind(j: str, key: str | None = None) -> str:
    return sql_kind_of(f"json_type({j}, {sql_str(sql_path_of(key))})" if key else f"json_type({j})")


def key_state(doc, key: str) -> Column:
    """``present`` / ``null`` / ``missing``."""
    v = get(doc, key)
    return F.when(v.isNull(), "missing").when(F.is_variant_null(v), "null").otherwise("present")


def sql_key_state(j: str, key: str) -> str:
    t = f"json_type({j}, {sql_str(sql_path_of(key))})"
    return f"CASE WHEN {t} IS NULL THEN 'missing' WHEN {t} = 'NULL' THEN 'null' ELSE 'present' END"


def as_text(v) -> Column:
    """Printable value: strings raw, JSON null / booleans as Python prints them,
    anything else as compact JSON."""
    v = _c(v)
    k = kind(v)
    return (F.when(k == "string", F.variant_get(v, "$", "string"))
            .when(k == "null", F.lit("None"))
            .when(k == "boolean", F.when(F.variant_get(v, "$", "boolean"), "True").otherwise("False"))
            .otherwise(F.to_json(v)))


def sql_as_text(j: str, key: str | None = None) -> str:
    p = sql_str(sql_path_of(key)) if key else "'$'"
    k = sql_kind(j, key)
    return (f"CASE WHEN {k} = 'string' THEN json_extract_string({j}, {p}) "
            f"WHEN {k} = 'null' THEN 'None' "
            f"WHEN {k} = 'boolean' THEN CASE WHEN json_extract_string({j}, {p}) = 'true' THEN 'True' ELSE 'False' END "
            f"ELSE cast(json_extract({j}, {p}) AS VARCHAR) END")


# --- C10 get with default -----------------------------------------------------------

def get_default(doc, path: str, default, target: str = "string") -> Column:
    """Nested value cast to ``target``; ``default`` only when the key is missing (JSON null stays NULL)."""
    found = F.variant_get(_c(doc), path, "variant")
    return F.when(found.isNull(), F.lit(default).cast(target)).otherwise(F.try_variant_get(found, "$", target))


# --- C11 emit -----------------------------------------------------------------------

def json_text(col) -> Column:
    """Compact JSON of a struct, keeping null fields and field order."""
    return F.to_json(_c(col), {"ignoreNullFields": "false"})


# --- C13 duration shape ---------------------------------------------------------------

def duration_shape(doc, key: str) -> Column:
    """``ok`` / ``not_iso`` / ``incomplete`` / ``not_string`` / ``null`` (null or missing)."""
    v = get(doc, key)
    k = kind(v)
    s = F.variant_get(v, "$", "string")
    return (F.when(k.isin("missing", "null"), "null")
            .when(k != "string", "not_string")
            .when(~s.startswith("PT"), "not_iso")
            .when(F.length(s) <= 2, "incomplete")
            .otherwise("ok"))


def sql_duration_shape(j: str, key: str) -> str:
    k = sql_kind(j, key)
    s = f"json_extract_string({j}, {sql_str(sql_path_of(key))})"
    return (f"CASE WHEN {k} IN ('missing', 'null') THEN 'null' WHEN {k} <> 'string' THEN 'not_string' "
            f"WHEN NOT starts_with({s}, 'PT') THEN 'not_iso' WHEN length({s}) <= 2 THEN 'incomplete' ELSE 'ok' END")
