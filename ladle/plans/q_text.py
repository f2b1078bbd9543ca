"""Queries: scalar text and JSON columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions import jsondoc as J
from ladle.functions import text as T
from ladle.plans.catalog import register
from ladle.plans.views import table, v_generations, v_judge, v_recipe_json, v_recipes, v_records, v_times, with_views


@register("safe_name", with_views(
    f"SELECT rid, name, {T.sql_safe_name('name')} AS safe_name FROM v_recipes", "v_recipes"))
def safe_name(spark, sf_dir):
    """C1 over every source record name."""
    r = v_recipes(spark, sf_dir)
    return r.select("rid", "name", T.safe_name("name").alias("safe_name"))


@register("human_time", with_views(
    f"SELECT event_id, seconds, {T.sql_human_time('seconds')} AS label, "
    f"{T.sql_human_time('seconds * 60')} AS label_x60 FROM v_times", "v_times"))
def human_time(spark, sf_dir):
    """C2 over every timing (and the same times read as minutes, to reach hours)."""
    t = v_times(spark, sf_dir)
    return t.select("event_id", "seconds", T.human_time("seconds").alias("label"),
                    T.human_time(F.col("seconds") * 60).alias("label_x60"))


@register("py_strip", f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(length({T.sql_py_strip('text')}) AS BIGINT) AS n_stripped,
  md5({T.sql_py_strip('text')}) AS stripped_md5, {T.sql_is_blank('text')} AS blank
FROM documents""")
def py_strip(spark, sf_dir):
    """C3 over every document (Unicode white space off both ends)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = T.py_strip("text")
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.length(s).cast("bigint").alias("n_stripped"),
                    F.md5(s).alias("stripped_md5"), T.is_blank("text").alias("blank"))


@register("response_tail", with_views(
    f"SELECT sample_id, {T.sql_response_tail('generated_text')} AS response FROM v_generations",
    "v_recipe_json", "v_generations"))
def response_tail(spark, sf_dir):
    """C4 over every decoded generation."""
    g = v_generations(spark, sf_dir)
    return g.select("sample_id", T.response_tail("generated_text").alias("response"))


@register("outer_json", with_views(
    f"SELECT sample_id, {T.sql_extract_answer_json('generated_text')} AS generated_json FROM v_generations",
    "v_recipe_json", "v_generations"))
def outer_json(spark, sf_dir):
    """C4 + C5: the JSON part of every generation."""
    g = v_generations(spark, sf_dir)
    return g.select("sample_id", T.extract_answer_json("generated_text").alias("generated_json"))


@register("fenced_json", with_views(
    f"SELECT sample_id, {T.sql_fenced_json('raw')} AS json_str, "
    f"CASE WHEN ({T.sql_fenced_json('raw')}) IS NULL THEN '{T.NO_JSON_ERROR}' END AS error FROM v_judge", "v_judge"))
def fenced_json(spark, sf_dir):
    """C6 over every judge reply: fenced / bare JSON, or the no-JSON error."""
    j = v_judge(spark, sf_dir)
    js = T.fenced_json("raw")
    return j.select("sample_id", js.alias("json_str"), F.when(js.isNull(), F.lit(T.NO_JSON_ERROR)).alias("error"))


_KEYS = ["@context", "@type", "name", "recipeIngredient", "recipeInstructions", "prepTime"]


def _state_cols(fn, prefix):
    return [fn(k).alias(f"{prefix}_{k.replace('@', 'at_')}") for k in _KEYS]


def _parsed(spark, sf_dir):
    return J.parse_tolerant(v_recipe_json(spark, sf_dir), "json_text", doc="doc", outcome="outcome", text="parsed")




def _parsed_sql(select: str) -> str:
    from ladle.operators.validate import sql_validate_ctes
    return with_views(select, "v_recipe_json", extra=sql_validate_ctes("v_recipe_json", "doc_id, k", "json_text", rules=()))


# Eight kinds of damage to a compact document, and the text that the repair must give.  SQL that both
# engines read, but for the group's name and the flag of a global replacement.
_DAMAGE = [
    ("translate(json_text, '\"', chr(39))", "json_text"),                                                        # single quotes
    ("regexp_replace(json_text, '\"([A-Za-z@]+)\":', '{group}:'{all})", "json_text"),                            # bare keys
    ("replace(json_text, '\",\"', '\" \"')", "json_text"),                                                       # no commas
    ("replace(json_text, '{', '{ // note, \"x\": [1}' || chr(10))", "json_text"),                               # comments
    ("'{\"flag\":True,none:None,' || substr(json_text, 2)", "'{\"flag\":true,\"none\":null,' || substr(json_text, 2)"),  # literals
    ("replace(json_text, 'Order ', 'Order \"no\" ')", "replace(json_text, 'Order ', 'Order ' || chr(92) || '\"no' || chr(92) || '\" ')"),  # stray quotes
    ("replace(replace(json_text, ',\"', ',,\"'), ']', ',]')", "json_text"),                                        # spare commas
    ("replace(json_text, ' of ', chr(10) || 'of ')", "replace(json_text, ' of ', chr(92) || 'nof ')"),           # raw line breaks
]
_DAMAGED, _WHOLE = ("CASE doc_id % 8 " + " ".join(f"WHEN {k} THEN {d[i]}" for k, d in enumerate(_DAMAGE)) + " END" for i in (0, 1))
_SQL_DAMAGED = _DAMAGED.replace("{group}", "\\1").replace("{all}", ", 'g'")


@register("json_repair", with_views(
    f"SELECT doc_id, CASE WHEN damaged = json_text THEN 'ok' ELSE 'repaired' END AS outcome, CASE WHEN damaged = json_text THEN json_text ELSE whole END AS json_text "
    f"FROM (SELECT doc_id, json_text, {_SQL_DAMAGED} AS damaged, {_WHOLE} AS whole FROM v_recipe_json "
    f"WHERE {J.sql_parse_ok('json_text')} AND left(json_text, 1) = '{{')", "v_recipe_json"))
def json_repair(spark, sf_dir):
    """Sound objects, damaged in eight ways, as the token repair gives them back (the twin knows only what was damaged)."""
    sound = v_recipe_json(spark, sf_dir).where(J.parse_strict("json_text").isNotNull() & F.startswith("json_text", F.lit("{")))
    damaged = sound.select("doc_id", F.expr(_DAMAGED.replace("{group}", "$1").replace("{all}", "")).alias("damaged"))
    return J.parse_tolerant(damaged, "damaged").select("doc_id", "outcome", "json_text")


@register("json_key_state", _parsed_sql(
    "SELECT doc_id, " + ", ".join(f"{J.sql_key_state('json_text', k)} AS state_{k.replace('@', 'at_')}" for k in _KEYS)
    + " FROM validated"))
def json_key_state(spark, sf_dir):
    """Present / null / missing per key, for every parsed document."""
    d = _parsed(spark, sf_dir)
    return d.select("doc_id", *_state_cols(lambda k: J.key_state("doc", k), "state"))


@register("json_kind", _parsed_sql(
    f"SELECT doc_id, {J.sql_kind('json_text')} AS kind_root, "
    + ", ".join(f"{J.sql_kind('json_text', k)} AS kind_{k.replace('@', 'at_')}" for k in _KEYS) + " FROM validated"))
def json_kind(spark, sf_dir):
    """Run-time JSON type of the root and of each key."""
    d = _parsed(spark, sf_dir)
    return d.select("doc_id", J.kind("doc").alias("kind_root"),
                    *_state_cols(lambda k: J.kind(J.get("doc", k)), "kind"))


@register("json_get_default", _parsed_sql(
    "SELECT doc_id, CASE WHEN json_type(json_text, '$.\"name\"') IS NULL THEN 'Unknown' ELSE json_extract_string(json_text, '$.\"name\"') END AS name, "
    "CASE WHEN json_type(json_text, '$.\"recipeInstructions\"[0].\"text\"') IS NULL THEN '' "
    "ELSE json_extract_string(json_text, '$.\"recipeInstructions\"[0].\"text\"') END AS first_step "
    "FROM validated"))
def json_get_default(spark, sf_dir):
    """Nested values, with defaults when missing (null stays null)."""
    d = _parsed(spark, sf_dir)
    return d.select("doc_id", J.get_default("doc", "$['name']", "Unknown").alias("name"),
                    J.get_default("doc", "$['recipeInstructions'][0]['text']", "").alias("first_step"))


@register("duration_shape", _parsed_sql(
    "SELECT doc_id, " + ", ".join(f"{J.sql_duration_shape('json_text', k)} AS {k}_shape" for k in ["prepTime", "cookTime", "totalTime"])
    + " FROM validated"))
def duration_shape(spark, sf_dir):
    """ISO duration shape of each duration key."""
    d = _parsed(spark, sf_dir)
    return d.select("doc_id", *[J.duration_shape("doc", k).alias(f"{k}_shape") for k in ["prepTime", "cookTime", "totalTime"]])


@register("json_emit", with_views(
    "SELECT rec_id, '{\"recipe\":' || recipe_json || ',\"reasoning\":' || coalesce(to_json(reasoning)::VARCHAR, 'null') || '}' AS record_json "
    "FROM v_records", "v_records"))
def json_emit(spark, sf_dir):
    """C11: the extraction record as compact JSON text, keys in order, nulls kept."""
    r = v_records(spark, sf_dir)
    reasoning = F.regexp_extract(F.to_json(F.struct(F.col("reasoning").alias("r")), {"ignoreNullFields": "false"}), r'^\{"r":(.*)\}$', 1)
    return r.select("rec_id", F.concat(F.lit('{"recipe":'), F.col("recipe_json"), F.lit(',"reasoning":'), reasoning, F.lit("}")).alias("record_json"))


@register("reasoning_strip", with_views(
    f"SELECT rec_id, {T.sql_strip_reasoning('content')} AS stripped FROM ("
    "SELECT rec_id, CASE WHEN reasoning IS NOT NULL AND reasoning <> '' AND NOT starts_with("
    f"{T.sql_py_strip('reasoning')}, '<think>') THEN '<think>' || chr(10) || {T.sql_py_strip('reasoning')} || chr(10) || '</think>' "
    "ELSE coalesce(reasoning, 'None') END || chr(10) || chr(10) || recipe_json AS content FROM v_records)", "v_records"))
def reasoning_strip(spark, sf_dir):
    """B8 on every assistant turn built from a record."""
    from ladle.operators.render import assistant_turn
    r = v_records(spark, sf_dir)
    return r.select("rec_id", T.strip_reasoning(assistant_turn("reasoning", "recipe_json")).alias("stripped"))


@register("preview_text", f"SELECT doc_id, {T.sql_preview('text')} AS preview FROM documents")
def preview_text(spark, sf_dir):
    """200-character previews of every document."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", T.preview("text").alias("preview"))
