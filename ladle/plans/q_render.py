"""Queries: prompt, message and chat rendering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions import text as T
from ladle.operators import render as R
from ladle.operators.route import examples, sql_outcome
from ladle.plans.catalog import register
from ladle.plans.views import v_blogs, v_recipes, v_records, v_turns, with_views

NL = "chr(10)"


def _sql_lit(s: str) -> str:
    return T.sql_text(s)


# --- B1 / B2 / B3 ---------------------------------------------------------------

_SQL_RECORD_PROMPT = (_sql_lit(R.RECORD_PROMPT_HEAD) + " || " + " || ".join(
    f"{NL} || {_sql_lit(label + ': ')} || coalesce(CAST({ {'group': 'grp'}.get(f, f)} AS VARCHAR), 'None')"
    for label, f in R.RECORD_PROMPT_LINES) + f" || {NL} || {NL} || " + _sql_lit(R.RECORD_PROMPT_TAIL))


@register("prompt_record", with_views(f"SELECT rid, {_SQL_RECORD_PROMPT} AS prompt FROM v_recipes", "v_recipes"))
def prompt_record(spark, sf_dir):
    """B1: the generation prompt of every source record."""
    r = v_recipes(spark, sf_dir)
    return r.select("rid", R.record_prompt({"group": "grp"}).alias("prompt"))


@register("prompt_extract", with_views(
    f"SELECT stem, {_sql_lit(R.EXTRACT_PREFIX)} || coalesce(text, 'None') AS prompt FROM v_blogs", "v_blogs"))
def prompt_extract(spark, sf_dir):
    """B2: the extraction prompt of every blog document."""
    b = v_blogs(spark, sf_dir)
    return b.select("stem", R.extraction_prompt("text").alias("prompt"))


@register("prompt_judge", with_views(
    f"SELECT r.stem, {_sql_lit(R.JUDGE_BLOG_HEAD)} || coalesce(b.text, 'None') || {_sql_lit(R.JUDGE_JSON_HEAD)} "
    f"|| coalesce(r.recipe_json, 'None') || {_sql_lit(R.JUDGE_TAIL)} AS prompt "
    "FROM v_records r JOIN v_blogs b ON r.stem = b.stem", "v_blogs", "v_records"))
def prompt_judge(spark, sf_dir):
    """Judge prompt for every record paired with its blog."""
    p = v_records(spark, sf_dir).join(v_blogs(spark, sf_dir), "stem")
    return p.select("stem", R.judge_prompt("text", "recipe_json").alias("prompt"))


# --- B4 / B6 / B7 ---------------------------------------------------------------

_SQL_WRAP = (f"CASE WHEN reasoning IS NOT NULL AND reasoning <> '' AND NOT starts_with({T.sql_py_strip('reasoning')}, '<think>') "
             f"THEN '<think>' || {NL} || {T.sql_py_strip('reasoning')} || {NL} || '</think>' ELSE reasoning END")


@register("reasoning_wrap", with_views(f"SELECT rec_id, {_SQL_WRAP} AS wrapped FROM v_records", "v_records"))
def reasoning_wrap(spark, sf_dir):
    """B4 over every record's reasoning."""
    r = v_records(spark, sf_dir)
    return r.select("rec_id", R.wrap_reasoning("reasoning").alias("wrapped"))


_SQL_ASSISTANT = f"coalesce({_SQL_WRAP}, 'None') || {NL} || {NL} || coalesce(recipe_json, 'None')"
_SQL_EXAMPLES = ("examples", f"SELECT r.stem, {_sql_lit(R.DEFAULT_SYSTEM_PROMPT)} AS system_content, "
                 f"{_sql_lit(R.EXTRACT_PREFIX)} || coalesce(b.text, 'None') AS user_content, {_SQL_ASSISTANT} AS assistant_content "
                 f"FROM v_records r JOIN v_blogs b ON r.stem = b.stem WHERE {sql_outcome('r.recipe_json')} = 'good'")


def _examples(spark, sf_dir):
    return examples(v_records(spark, sf_dir), v_blogs(spark, sf_dir))


@register("training_example", with_views(
    "SELECT stem, system_content, user_content, assistant_content, 3 AS n_messages FROM examples",
    "v_blogs", "v_records", extra=[_SQL_EXAMPLES]))
def training_example(spark, sf_dir):
    """B5 + B6: the 3-message example of every paired record (flattened by role)."""
    e = _examples(spark, sf_dir)
    return e.select("stem", F.col("messages")[0]["content"].alias("system_content"),
                    F.col("messages")[1]["content"].alias("user_content"),
                    F.col("messages")[2]["content"].alias("assistant_content"),
                    F.size("messages").alias("n_messages"))


@register("chat_convert", with_views(
    f"SELECT stem, system_content, user_content, {T.sql_strip_reasoning('assistant_content')} AS assistant_content FROM examples",
    "v_blogs", "v_records", extra=[_SQL_EXAMPLES]))
def chat_convert(spark, sf_dir):
    """Chat form of every example, reasoning stripped from the answer."""
    c = _examples(spark, sf_dir).select("stem", R.to_chat("messages").alias("conv"))
    return c.select("stem", F.col("conv")[0]["content"].alias("system_content"), F.col("conv")[1]["content"].alias("user_content"),
                    F.col("conv")[2]["content"].alias("assistant_content"))


# --- B9 / B10 / B11 / B12 / F9 -----------------------------------------------------

def _chats(spark, sf_dir):
    return R.nest_turns(v_turns(spark, sf_dir), "conv_id", "turn", out="messages")


_SQL_CHATS = ("chats", "SELECT conv_id, list(struct_pack(role := role, content := content) ORDER BY turn) AS messages "
                       "FROM v_turns GROUP BY conv_id")


def _sql_render(conv: str, gen: bool) -> str:
    c = f"list_filter({conv}, lambda lr_f: lr_f.role <> 'assistant')" if gen else conv
    has_sys = f"coalesce({c}[1].role = 'system', false)"
    prefix = f"CASE WHEN {has_sys} THEN {T.sql_py_strip(f'{c}[1].content')} || {NL} || {NL} ELSE '' END"
    rest = f"CASE WHEN {has_sys} THEN {c}[2:] ELSE {c} END"
    target = f"coalesce(nullif(list_position(list_transform({rest}, lambda lr_m: lr_m.role), 'user'), 0), 1)"
    turn = (f"'<start_of_turn>' || CASE WHEN lr_x.role = 'assistant' THEN 'model' ELSE lr_x.role END || {NL} || "
            f"CASE WHEN lr_i = {target} THEN {prefix} ELSE '' END || {T.sql_py_strip("coalesce(lr_x.content, '')")} || '<end_of_turn>' || {NL}")
    body = f"coalesce(array_to_string(list_transform({rest}, lambda lr_x, lr_i: {turn}), ''), '')"
    return f"{body} || '<start_of_turn>model' || {NL}" if gen else body


@register("turns_nest", with_views(
    "SELECT conv_id, CAST(len(messages) AS INTEGER) AS n_turns, "
    "array_to_string(list_transform(messages, lambda m: m.role), ',') AS roles, "
    "md5(array_to_string(list_transform(messages, lambda m: m.content), chr(30))) AS content_md5 FROM chats",
    "v_turns", extra=[_SQL_CHATS]))
def turns_nest(spark, sf_dir):
    """Turns gathered into one message array per conversation (shape + content hash)."""
    c = _chats(spark, sf_dir)
    return c.select("conv_id", F.size("messages").alias("n_turns"),
                    F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
                    F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\u001e")).alias("content_md5"))


@register("turns_unnest", with_views(
    "SELECT conv_id, CAST(p - 1 AS BIGINT) AS turn, messages[p].role AS role, messages[p].content AS content "
    "FROM (SELECT conv_id, messages, unnest(range(1, len(messages) + 1)) AS p FROM chats)",
    "v_turns", extra=[_SQL_CHATS]))
def turns_unnest(spark, sf_dir):
    """B11 inverse: back to one row per turn, positions 0..n-1."""
    return R.unnest_turns(_chats(spark, sf_dir), "conv_id", "messages")


@register("chat_render", with_views(
    f"SELECT conv_id, {_sql_render('messages', False)} AS text FROM chats", "v_turns", extra=[_SQL_CHATS]))
def chat_render(spark, sf_dir):
    """Chat-template text of every conversation."""
    c = _chats(spark, sf_dir)
    return c.select("conv_id", R.render_chat("messages").alias("text"))


@register("chat_render_gen", with_views(
    f"SELECT conv_id, {_sql_render('messages', True)} AS text FROM chats", "v_turns", extra=[_SQL_CHATS]))
def chat_render_gen(spark, sf_dir):
    """Generation prompt (no assistant turns, open model turn) of every conversation."""
    c = _chats(spark, sf_dir)
    return c.select("conv_id", R.render_chat("messages", add_generation_prompt=True).alias("text"))


_SQL_SPANS = ("spans", f"""
  SELECT conv_id, CAST(p - 1 - empty_first AS BIGINT) AS seg, CAST(length(s) AS BIGINT) AS length,
    CAST(CASE WHEN mark = 'model' THEN {len(R.MODEL_MARK)} WHEN mark = 'user' THEN length(s)
              WHEN coalesce(mode, '') = 'model' THEN 0 ELSE length(s) END AS BIGINT) AS masked,
    CAST(length(s) - CASE WHEN mark = 'model' THEN {len(R.MODEL_MARK)} WHEN mark = 'user' THEN length(s)
              WHEN coalesce(mode, '') = 'model' THEN 0 ELSE length(s) END AS BIGINT) AS kept
  FROM (SELECT conv_id, p, CASE WHEN parts[1] = '' THEN 1 ELSE 0 END AS empty_first, parts[p] AS s, marks[p] AS mark, list_filter(marks[1:p], lambda m: m IS NOT NULL)[-1] AS mode
        FROM (SELECT conv_id, parts, marks, unnest(range(1, len(parts) + 1)) AS p
              FROM (SELECT conv_id, parts, list_transform(parts, lambda x: CASE
                      WHEN starts_with(x, '<start_of_turn>model' || {NL}) THEN 'model'
                      WHEN starts_with(x, '<start_of_turn>user' || {NL}) THEN 'user' END) AS marks
                    FROM (SELECT conv_id, list_transform(string_split(text, '<start_of_turn>'), lambda x, i: CASE WHEN i = 1 THEN x ELSE '<start_of_turn>' || x END) AS parts
                          FROM (SELECT conv_id, {_sql_render('messages', False)} AS text FROM chats)))))
  WHERE length(s) > 0""")


def _spans(spark, sf_dir):
    rendered = _chats(spark, sf_dir).select("conv_id", R.render_chat("messages").alias("text"))
    return R.supervised_spans(rendered, "conv_id")


@register("supervised_spans", with_views(
    "SELECT conv_id, seg, length, masked, kept FROM spans", "v_turns", extra=[_SQL_CHATS, _SQL_SPANS]))
def supervised_spans(spark, sf_dir):
    """Kept / masked characters per template segment."""
    return _spans(spark, sf_dir)


@register("supervised_ratio", with_views(
    "SELECT CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(masked) AS BIGINT) AS masked, "
    "round(CAST(sum(kept) AS DOUBLE) / CAST(sum(kept) + sum(masked) AS DOUBLE), 6) AS ratio FROM spans",
    "v_turns", extra=[_SQL_CHATS, _SQL_SPANS]))
def supervised_ratio(spark, sf_dir):
    """share of template characters that are trained on."""
    s = _spans(spark, sf_dir).agg(F.sum("kept").alias("kept"), F.sum("masked").alias("masked"))
    return s.select(F.col("kept").cast("bigint"), F.col("masked").cast("bigint"),
                    F.round(F.col("kept").cast("double") / (F.col("kept") + F.col("masked")).cast("double"), 6).alias("ratio"))
