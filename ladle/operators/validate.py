"""Rule validation of schema.org Recipe JSON documents.

``validate(df, col)`` is one narrow projection: tolerant parse (C7), then every
rule as a Column over the parsed VARIANT.  No shuffle, no UDF.  Rules run in
the declared order and each yields messages at two levels; ``errors`` and
``warnings`` are the non-null messages in that order and ``is_valid`` is
``size(errors) = 0``.

``sql_validate`` builds the same rules as DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.jsondoc import (
    _sql_drop_trailing_commas, _sql_fence_cut, as_text, parse_tolerant, sql_as_text, sql_close_open_ctes,
    sql_kind, sql_kind_of, sql_parse_ok, sql_path_of,
)
from ladle.functions.text import is_blank, sql_is_blank, sql_outer_json, sql_str

# Field lists and their declared order.
REQUIRED_FIELDS = ["@context", "@type", "name"]
OPTIONAL_FIELDS = ["description", "prepTime", "cookTime", "totalTime", "recipeYield", "recipeCategory",
                   "recipeCuisine", "keywords", "recipeIngredient", "recipeInstructions"]
# The rule of each field, in the order in which messages appear.
RULE_ORDER = [("context", "@context"), ("type", "@type"), ("string", "name"), ("string", "description"),
              ("ingredients", "recipeIngredient"), ("instructions", "recipeInstructions"),
              ("duration", "prepTime"), ("duration", "cookTime"), ("duration", "totalTime"),
              ("string", "recipeYield"), ("string", "recipeCategory"), ("string", "recipeCuisine"),
              ("string", "keywords")]

# Message texts.
SCHEMA_ORG = "https://schema.org"
RECIPE = "Recipe"
HOW_TO_STEP = "HowToStep"
MSG_NOT_OBJECT = "Recipe JSON must be an object/dictionary"
MSG_INVALID = "Invalid JSON syntax: not parseable after bounded repair"
MSG_MISSING_REQUIRED = "Missing required fields: "
MSG_MISSING_OPTIONAL = "Missing optional fields: "

FIELDS = sorted(set(REQUIRED_FIELDS + OPTIONAL_FIELDS))


def _col_name(field: str) -> str:
    return "_v_" + field.replace("@", "at_")


def _absent(k: Column) -> Column:
    return k.isin("missing", "null")


def _s(field: str) -> Column:
    return F.col(_col_name(field) + "_s")


def _k(field: str) -> Column:
    return F.col(_col_name(field) + "_k")


def _items(field: str) -> Column:
    return F.col(_col_name(field) + "_items")


def _none() -> Column:
    return F.array().cast("array<string>")


def _one(broken: Column, message) -> Column:
    """The list of a rule's message, empty where it holds: lists without NULLs are joined by compiled code alone."""
    return F.when(broken, F.array(message if isinstance(message, Column) else F.lit(message))).otherwise(_none())


def _rule(kind_name: str, field: str) -> tuple[list[Column], list[Column]]:
    """(error arrays, warning arrays) of one rule; an array may be NULL but holds none."""
    k = _k(field)
    if kind_name in ("ingredients", "instructions"):
        items = _items(field)
        head = ([_one(~_absent(k) & items.isNull(), f"{field} must be an array")], [_one(F.size(items) == 0, f"{field} is empty")])
        found = F.filter(items, lambda x: x.isNotNull())
        if kind_name == "ingredients":
            return head[0] + [found], head[1]
        return (head[0] + [F.flatten(F.transform(found, lambda x: x["errors"]))],
                head[1] + [F.flatten(F.transform(found, lambda x: x["warnings"]))])
    s, is_string = _s(field), k == "string"
    errors = [_one(~_absent(k) & ~is_string, f"{field} must be a string")]
    if kind_name == "context":
        return errors, [_one(is_string & (s != SCHEMA_ORG), F.concat(F.lit("@context is '"), s, F.lit(f"', expected '{SCHEMA_ORG}'")))]
    if kind_name == "type":
        return errors + [_one(is_string & (s != RECIPE), F.concat(F.lit(f"@type must be '{RECIPE}', got '"), s, F.lit("'")))], []
    if kind_name == "string":
        return errors, [_one(is_string & is_blank(s), f"{field} is empty")]
    return errors, [
        _one(is_string & ~s.startswith("PT"),
             F.concat(F.lit(f"{field} should be in ISO 8601 duration format (e.g., 'PT15M'), got '"), s, F.lit("'"))),
        _one(is_string & s.startswith("PT") & (F.length(s) <= 2), F.concat(F.lit(f"{field} appears to be incomplete: '"), s, F.lit("'")))]


def _is_string(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def _item_kind(v: Column) -> Column:
    """``missing``, ``string``, ``null`` or ``other``: all that the rules tell apart, without the look-up of a kind's name
    and without the schema of every item that ``kind`` prints of a list."""
    return (F.when(v.isNull(), F.lit("missing")).when(F.is_variant_null(v), F.lit("null"))
            .when(_is_string(v), F.lit("string")).otherwise(F.lit("other")))


def _ingredient_items(field: str, v: Column) -> Column:
    """For each item of a list its message, NULL for a good one; NULL for what is no list."""
    return F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: F.when(
        ~F.coalesce(_is_string(x), F.lit(False)), F.concat(F.lit(f"{field}["), i.cast("string"), F.lit("] must be a string"))))


def _step_items(field: str, v: Column) -> Column:
    """For each item of a list the struct of its errors and warnings, NULL for a good one; NULL for what is no list.

    One cast turns the items into structs of the two keys the rules look at: a non-object
    item becomes NULL, a missing key SQL NULL, a JSON null a variant null.  Good items,
    which most are, are told first and by themselves.
    """
    items = F.try_variant_get(v, "$", "array<struct<`@type`:variant,text:variant>>")

    def item(it: Column, i: Column) -> Column:
        t, tx = it["@type"], it["text"]
        # nothing but a string has this text
        how_to_step = F.try_variant_get(t, "$", "string") == HOW_TO_STEP
        good = how_to_step & _is_string(tx) & ~is_blank(F.try_variant_get(tx, "$", "string"))
        pre = F.concat(F.lit(f"{field}["), i.cast("string"), F.lit("]"))
        obj = it.isNotNull()
        errors = F.array(
            F.when(~obj, F.concat(pre, F.lit(" must be an object"))),
            F.when(obj & t.isNull(), F.concat(pre, F.lit(" missing @type field"))),
            F.when(obj & t.isNotNull() & ~F.coalesce(how_to_step, F.lit(False)),
                   F.concat(pre, F.lit(f" @type must be '{HOW_TO_STEP}', got '"), as_text(t), F.lit("'"))),
            F.when(obj & tx.isNull(), F.concat(pre, F.lit(" missing text field"))),
            F.when(obj & tx.isNotNull() & ~_is_string(tx), F.concat(pre, F.lit(" text must be a string"))))
        warnings = F.array(F.when(obj & _is_string(tx) & is_blank(F.try_variant_get(tx, "$", "string")), F.concat(pre, F.lit(" text is empty"))))
        return F.when(~F.coalesce(good, F.lit(False)), F.struct(*[
            F.filter(a, lambda m: m.isNotNull()).alias(n) for n, a in (("errors", errors), ("warnings", warnings))]))
    return F.transform(items, item)


#: fields whose rule looks at a list's items
_LISTS = {f: _step_items if k == "instructions" else _ingredient_items for k, f in RULE_ORDER if k in ("ingredients", "instructions")}


def _present_list(fields: list[str], prefix: str) -> Column:
    joined = F.array_join(F.array(*[F.when(_k(f) == "missing", F.lit(f)) for f in fields]), ", ")
    return _one(joined != "", F.concat(F.lit(prefix), joined))


def _joined(arrays: list[Column]) -> Column:
    return F.concat(*[F.coalesce(a, _none()) for a in arrays]) if arrays else _none()


def _selected(rules: tuple[str, ...] | None) -> tuple[bool, bool, list[tuple[str, str]]]:
    if rules is None:
        return True, True, RULE_ORDER
    return ("required" in rules, "optional" in rules,
            [(k, f) for k, f in RULE_ORDER if k in rules or f in rules])


def validate(df: DataFrame, col: str, keep_doc: bool = False, rules: tuple[str, ...] | None = None,
             warnings: bool = True) -> DataFrame:
    """Add ``outcome``, ``json_text``, ``is_valid``, ``errors``, ``warnings``.

    ``rules`` limits the checks to some of ``required``, ``optional``, ``context``,
    ``type``, ``string``, ``ingredients``, ``instructions``, ``duration`` (or field
    names); parse and root-object checks always run.  ``warnings=False`` skips
    the warning-level checks (``warnings`` is then empty) for callers that only
    count errors.
    """
    use_req, use_opt, order = _selected(rules)
    out = parse_tolerant(df, col, doc="_doc", outcome="outcome", text="json_text")
    # One cast reads every checked key: NULL when the root is not an object;
    # per key SQL NULL when missing, a variant null when JSON null.
    shape = "struct<" + ",".join(f"`{f}`:variant" for f in FIELDS) + ">"
    out = out.withColumn("_fields", F.try_variant_get(F.col("_doc"), "$", shape))
    out = out.withColumn("_root_k", F.when(F.col("_doc").isNull(), F.lit("missing"))
                         .when(F.col("_fields").isNull(), F.lit("other")).otherwise(F.lit("object")))
    # What the rules look at, worked out once: of each value its kind and text, of a list's items their messages.
    # The document goes here, as each further step would copy it.
    keep = [c for c in out.columns if c != "_fields" and (keep_doc or c != "_doc")]
    seen = []
    for f in FIELDS:
        v = F.col("_fields")[f]
        seen.append(_item_kind(v).alias(_col_name(f) + "_k"))
        seen.append(_LISTS[f](f, v).alias(_col_name(f) + "_items") if f in _LISTS
                    else F.when(_is_string(v), F.try_variant_get(v, "$", "string")).alias(_col_name(f) + "_s"))
    out = out.select(*keep, *seen)
    errs = [_present_list(REQUIRED_FIELDS, MSG_MISSING_REQUIRED)] if use_req else []
    warns = [_present_list(OPTIONAL_FIELDS, MSG_MISSING_OPTIONAL)] if use_opt else []
    for kind_name, field in order:
        e, w = _rule(kind_name, field)
        errs += e
        warns += w
    rejected = F.col("outcome") == "rejected"
    not_obj = F.col("_root_k") != "object"
    errors = (F.when(rejected, F.array(F.lit(MSG_INVALID)))
              .when(not_obj, F.array(F.lit(MSG_NOT_OBJECT)))
              .otherwise(_joined(errs)))
    warning_list = (F.when(rejected | not_obj, F.array().cast("array<string>")).otherwise(_joined(warns))
                    if warnings else F.array().cast("array<string>"))
    keep = [c for c in keep if c != "_root_k"]
    # The messages leave through a one-row generator: a filter on them (or on
    # is_valid) stops at the generator instead of being pushed down and inlined
    # into every rule, which would evaluate the rules twice and grow the plan
    # with every reference.  The outer form infers no size() filter either.
    # They are columns before it, as a generator's own expressions are not compiled.
    out = out.select(*keep, errors.alias("_errors"), warning_list.alias("_warnings"))
    out = out.select(*keep, F.inline_outer(F.array(F.struct(F.col("_errors").alias("errors"), F.col("_warnings").alias("warnings")))))
    out = out.withColumn("is_valid", F.size("errors") == 0)
    return out.withColumnRenamed("_doc", "doc") if keep_doc else out


def findings(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (key..., level, position, message), from a single explode."""
    tagged = F.concat(
        F.transform("errors", lambda m, i: F.struct(F.lit("error").alias("level"), i.alias("pos"), m.alias("message"))),
        F.transform("warnings", lambda m, i: F.struct(F.lit("warning").alias("level"), i.alias("pos"), m.alias("message"))))
    # explode_outer + a filter on the generated column: a plain explode makes the
    # optimizer infer a size() filter and push it down into the rule projection,
    # which would evaluate every rule twice.
    return (df.select(*keys, F.explode_outer(tagged).alias("f")).filter(F.col("f").isNotNull())
              .select(*keys, "f.level", "f.pos", "f.message"))


# --- SQL twin ----------------------------------------------------------------------

def _sql_list(items: list[str]) -> str:
    return "[" + ", ".join(items) + "]" if items else "[]::VARCHAR[]"


def _sql_concat(lists: list[str]) -> str:
    if not lists:
        return "[]::VARCHAR[]"
    out = lists[0]
    for x in lists[1:]:
        out = f"list_concat({out}, {x})"
    return out


def _sql_rule(kind_name: str, field: str, j: str) -> tuple[list[str], list[str]]:
    k = sql_kind(j, field)
    p = sql_str(sql_path_of(field))
    s = f"json_extract_string({j}, {p})"
    absent = f"({k} IN ('missing', 'null'))"
    if kind_name == "context":
        return ([f"CASE WHEN NOT {absent} AND {k} <> 'string' THEN '@context must be a string' END"],
                [f"CASE WHEN {k} = 'string' AND {s} <> '{SCHEMA_ORG}' THEN '@context is ''' || {s} || ''', expected ''{SCHEMA_ORG}''' END"])
    if kind_name == "type":
        return ([f"CASE WHEN NOT {absent} AND {k} <> 'string' THEN '@type must be a string' END",
                 f"CASE WHEN {k} = 'string' AND {s} <> '{RECIPE}' THEN '@type must be ''{RECIPE}'', got ''' || {s} || '''' END"], [])
    if kind_name == "string":
        return ([f"CASE WHEN NOT {absent} AND {k} <> 'string' THEN '{field} must be a string' END"],
                [f"CASE WHEN {k} = 'string' AND {sql_is_blank(s)} THEN '{field} is empty' END"])
    if kind_name == "duration":
        return ([f"CASE WHEN NOT {absent} AND {k} <> 'string' THEN '{field} must be a string' END"],
                [f"CASE WHEN {k} = 'string' AND NOT starts_with({s}, 'PT') THEN '{field} should be in ISO 8601 duration format (e.g., ''PT15M''), got ''' || {s} || '''' END",
                 f"CASE WHEN {k} = 'string' AND starts_with({s}, 'PT') AND length({s}) <= 2 THEN '{field} appears to be incomplete: ''' || {s} || '''' END"])
    raise ValueError(kind_name)


def _sql_array_rule(kind_name: str, field: str, j: str) -> tuple[list[str], list[str]]:
    """List-valued parts (as SQL list expressions) of the two array rules."""
    k = sql_kind(j, field)
    p = sql_path_of(field)
    items = f"json_extract({j}, {sql_str(p + '[*]')})"
    is_arr = f"({k} = 'array')"
    n = f"json_array_length({j}, {sql_str(p)})"
    head_e = f"[CASE WHEN {k} NOT IN ('missing', 'null') AND NOT {is_arr} THEN '{field} must be an array' END]"
    head_w = f"[CASE WHEN {is_arr} AND {n} = 0 THEN '{field} is empty' END]"
    pre = f"'{field}[' || CAST(i - 1 AS VARCHAR) || ']'"
    if kind_name == "ingredients":
        per = (f"list_transform({items}, lambda x, i: CASE WHEN {sql_kind('x')} <> 'string' "
               f"THEN {pre} || ' must be a string' END)")
        return [head_e, f"CASE WHEN {is_arr} THEN {per} ELSE []::VARCHAR[] END"], [head_w]
    kx, kt, ktx = sql_kind("x"), sql_kind("x", "@type"), sql_kind("x", "text")
    t_s = "json_extract_string(x, '$.\"@type\"')"
    tx_s = "json_extract_string(x, '$.\"text\"')"
    per_e = (f"flatten(list_transform({items}, lambda x, i: ["
             f"CASE WHEN {kx} <> 'object' THEN {pre} || ' must be an object' END, "
             f"CASE WHEN {kx} = 'object' AND {kt} = 'missing' THEN {pre} || ' missing @type field' END, "
             f"CASE WHEN {kx} = 'object' AND {kt} <> 'missing' AND NOT ({kt} = 'string' AND {t_s} = '{HOW_TO_STEP}') "
             f"THEN {pre} || ' @type must be ''{HOW_TO_STEP}'', got ''' || ({sql_as_text('x', '@type')}) || '''' END, "
             f"CASE WHEN {kx} = 'object' AND {ktx} = 'missing' THEN {pre} || ' missing text field' END, "
             f"CASE WHEN {kx} = 'object' AND {ktx} <> 'missing' AND {ktx} <> 'string' THEN {pre} || ' text must be a string' END]))")
    per_w = (f"list_transform({items}, lambda x, i: CASE WHEN {kx} = 'object' AND {ktx} = 'string' "
             f"AND {sql_is_blank(tx_s)} THEN {pre} || ' text is empty' END)")
    return ([head_e, f"CASE WHEN {is_arr} THEN {per_e} ELSE []::VARCHAR[] END"],
            [head_w, f"CASE WHEN {is_arr} THEN {per_w} ELSE []::VARCHAR[] END"])


def sql_tolerant_ctes(src: str, key_cols: str, text_col: str, out: str = "v_parsed") -> list[tuple[str, str]]:
    """C7 as DuckDB CTEs ending in ``out`` (key columns + outcome + json_text);
    staged so that each rung is written once: t1 from t0, t2 from t1, ..."""
    return [
        (f"{out}_c1", f"SELECT {key_cols}, {text_col} AS t0, {_sql_fence_cut(text_col)} AS t1 FROM {src}"),
        (f"{out}_c2", f"SELECT *, {sql_outer_json('t1')} AS t2 FROM {out}_c1"),
        (f"{out}_c3", f"SELECT *, {_sql_drop_trailing_commas('t2')} AS t3 FROM {out}_c2"),
        *sql_close_open_ctes(f"{out}_c3", "t1", f"{out}_c4"),
        (f"{out}_ok", "SELECT *, " + ", ".join(f"{sql_parse_ok(f't{i}')} AS ok{i}" for i in range(5)) + f" FROM {out}_c4"),
        (f"{out}!", f"SELECT {key_cols}, CASE WHEN ok0 THEN 'ok' WHEN ok1 OR ok2 OR ok3 OR ok4 THEN 'repaired' ELSE 'rejected' END AS outcome, "
                    f"CASE WHEN ok0 THEN t0 WHEN ok1 THEN t1 WHEN ok2 THEN t2 WHEN ok3 THEN t3 WHEN ok4 THEN t4 END AS json_text FROM {out}_ok"),
    ]


def sql_validate_ctes(src: str, key_cols: str, text_col: str, rules: tuple[str, ...] | None = None) -> list[tuple[str, str]]:
    """CTEs ending in ``validated`` with key columns + outcome, json_text, errors, warnings, is_valid."""
    stage = sql_tolerant_ctes(src, key_cols, text_col, out="v_parsed")
    j = "json_text"
    req = "concat_ws(', ', " + ", ".join(f"CASE WHEN {sql_kind(j, f)} = 'missing' THEN '{f}' END" for f in REQUIRED_FIELDS) + ")"
    opt = "concat_ws(', ', " + ", ".join(f"CASE WHEN {sql_kind(j, f)} = 'missing' THEN '{f}' END" for f in OPTIONAL_FIELDS) + ")"
    use_req, use_opt, order = _selected(rules)
    errs = [f"[CASE WHEN {req} <> '' THEN '{MSG_MISSING_REQUIRED}' || {req} END]"] if use_req else []
    warns = [f"[CASE WHEN {opt} <> '' THEN '{MSG_MISSING_OPTIONAL}' || {opt} END]"] if use_opt else []
    for kind_name, field in order:
        if kind_name in ("ingredients", "instructions"):
            e, w = _sql_array_rule(kind_name, field, j)
            errs += e
            warns += w
        else:
            e, w = _sql_rule(kind_name, field, j)
            if e:
                errs.append(_sql_list(e))
            if w:
                warns.append(_sql_list(w))
    root = sql_kind_of(f"json_type({j})")
    stage.append(("v_rules", f"SELECT *, {root} AS root_k, "
                             f"list_filter({_sql_concat(errs)}, lambda x: x IS NOT NULL) AS e_all, "
                             f"list_filter({_sql_concat(warns)}, lambda x: x IS NOT NULL) AS w_all FROM v_parsed"))
    stage.append(("validated!", f"SELECT {key_cols}, outcome, json_text, "
                               f"CASE WHEN outcome = 'rejected' THEN ['{MSG_INVALID}'] WHEN root_k <> 'object' THEN ['{MSG_NOT_OBJECT}'] ELSE e_all END AS errors, "
                               f"CASE WHEN outcome = 'rejected' OR root_k <> 'object' THEN []::VARCHAR[] ELSE w_all END AS warnings "
                               "FROM v_rules"))
    return stage
