"""Fixture views over the given tables (FIXTURES.md section 4).

Each ``v_*`` function builds the view from the parquet tables with the
DataFrame API; ``SQL_VIEWS`` holds the same definitions as DuckDB SQL bodies for
the oracle (``with_views`` wraps a query in the CTEs it needs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.text import md5_number, sql_md5_number

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The variant applied to each recipe document, by o_orderkey % 16.
RECIPE_VARIANTS = {
    0: "none",
    1: "no name",
    2: "@type is Article",
    3: "@context is http://schema.org",
    4: "name is a number",
    5: "name is null",
    6: 'recipeIngredient is "flour"',
    7: 'recipeIngredient is ["flour",2]',
    8: "recipeIngredient is []",
    9: 'recipeInstructions is ["stir"]',
    10: "instruction @type is Step",
    11: "first step has no text, second is blank",
    12: "prepTime is 15 minutes",
    13: "prepTime is PT",
    14: "wrapped in [ ]",
    15: "last character cut",
}

STEP_OPEN = '{"@type":"HowToStep","text":"Pick part '


def v_recipe_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-LD recipe text per order that has line items (doc_id, k, json_text)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    per_order = li.groupBy("l_orderkey").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.concat(
            F.col("l_quantity").cast("bigint").cast("string"), F.lit(" units of part "),
            F.col("l_partkey").cast("string")))), lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ",").alias("ingr"),
        F.array_join(F.sort_array(F.collect_list(F.concat(
            F.lit(STEP_OPEN), F.col("l_partkey").cast("string"), F.lit('"}')))), ",").alias("steps"),
        F.count(F.lit(1)).alias("n"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    d = per_order.join(o, per_order.l_orderkey == o.o_orderkey, "inner")
    k = (F.col("o_orderkey") % 16).cast("int")
    ok = F.col("o_orderkey").cast("string")
    ctx = F.when(k == 3, F.lit('"@context":"http://schema.org"')).otherwise(F.lit('"@context":"https://schema.org"'))
    typ = F.when(k == 2, F.lit('"@type":"Article"')).otherwise(F.lit('"@type":"Recipe"'))
    name = (F.when(k == 1, F.lit(None).cast("string"))
            .when(k == 4, F.concat(F.lit('"name":'), ok))
            .when(k == 5, F.lit('"name":null'))
            .otherwise(F.concat(F.lit('"name":"Order '), ok, F.lit('"'))))
    desc = F.concat(F.lit('"description":"Customer '), F.col("o_custkey").cast("string"), F.lit('"'))
    ingr = (F.when(k == 6, F.lit('"recipeIngredient":"flour"'))
            .when(k == 7, F.lit('"recipeIngredient":["flour",2]'))
            .when(k == 8, F.lit('"recipeIngredient":[]'))
            .otherwise(F.concat(F.lit('"recipeIngredient":['), F.col("ingr"), F.lit("]"))))
    steps = (F.when(k == 9, F.lit('"stir"'))
             .when(k == 10, F.replace(F.col("steps"), F.lit('"@type":"HowToStep"'), F.lit('"@type":"Step"')))
             .when(k == 11, F.concat(F.lit('{"@type":"HowToStep"},{"@type":"HowToStep","text":" "},'), F.col("steps")))
             .otherwise(F.col("steps")))
    instr = F.concat(F.lit('"recipeInstructions":['), steps, F.lit("]"))
    prep = (F.when(k == 12, F.lit('"prepTime":"15 minutes"'))
            .when(k == 13, F.lit('"prepTime":"PT"'))
            .otherwise(F.lit('"prepTime":"PT15M"')))
    yld = F.concat(F.lit('"recipeYield":"'), F.col("n").cast("string"), F.lit(' lines"'))
    obj = F.concat(F.lit("{"), F.concat_ws(",", ctx, typ, name, desc, ingr, instr, prep, yld), F.lit("}"))
    text = (F.when(k == 14, F.concat(F.lit("["), obj, F.lit("]")))
            .when(k == 15, F.expr("substring(_obj, 1, length(_obj) - 1)"))
            .otherwise(obj))
    return (d.withColumn("_obj", obj)
             .select(F.col("o_orderkey").alias("doc_id"), k.alias("k"),
                     text.alias("json_text")))


SQL_V_RECIPE_JSON = """
  SELECT doc_id, k,
    CASE WHEN k = 14 THEN '[' || obj || ']' WHEN k = 15 THEN substr(obj, 1, length(obj) - 1) ELSE obj END AS json_text
  FROM (
    SELECT o_orderkey AS doc_id, CAST(o_orderkey % 16 AS INTEGER) AS k,
      '{' || concat_ws(',',
        CASE WHEN o_orderkey % 16 = 3 THEN '"@context":"http://schema.org"' ELSE '"@context":"https://schema.org"' END,
        CASE WHEN o_orderkey % 16 = 2 THEN '"@type":"Article"' ELSE '"@type":"Recipe"' END,
        CASE WHEN o_orderkey % 16 = 1 THEN NULL
             WHEN o_orderkey % 16 = 4 THEN '"name":' || CAST(o_orderkey AS VARCHAR)
             WHEN o_orderkey % 16 = 5 THEN '"name":null'
             ELSE '"name":"Order ' || CAST(o_orderkey AS VARCHAR) || '"' END,
        '"description":"Customer ' || CAST(o_custkey AS VARCHAR) || '"',
        CASE WHEN o_orderkey % 16 = 6 THEN '"recipeIngredient":"flour"'
             WHEN o_orderkey % 16 = 7 THEN '"recipeIngredient":["flour",2]'
             WHEN o_orderkey % 16 = 8 THEN '"recipeIngredient":[]'
             ELSE '"recipeIngredient":[' || ingr || ']' END,
        '"recipeInstructions":[' ||
        CASE WHEN o_orderkey % 16 = 9 THEN '"stir"'
             WHEN o_orderkey % 16 = 10 THEN replace(steps, '"@type":"HowToStep"', '"@type":"Step"')
             WHEN o_orderkey % 16 = 11 THEN '{"@type":"HowToStep"},{"@type":"HowToStep","text":" "},' || steps
             ELSE steps END || ']',
        CASE WHEN o_orderkey % 16 = 12 THEN '"prepTime":"15 minutes"'
             WHEN o_orderkey % 16 = 13 THEN '"prepTime":"PT"'
             ELSE '"prepTime":"PT15M"' END,
        '"recipeYield":"' || CAST(n AS VARCHAR) || ' lines"') || '}' AS obj
    FROM (
      SELECT l_orderkey,
        array_to_string(list_transform(list_sort(list(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' units of part ' || CAST(l_partkey AS VARCHAR))), lambda x: '"' || x || '"'), ',') AS ingr,
        array_to_string(list_sort(list('{"@type":"HowToStep","text":"Pick part ' || CAST(l_partkey AS VARCHAR) || '"}')), ',') AS steps,
        count(*) AS n
      FROM lineitem GROUP BY l_orderkey
    ) li JOIN orders ON li.l_orderkey = orders.o_orderkey
  ) base
"""


def v_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records (M1): one row per part with line items, all text."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    # orders are told apart in the group's set: a distinct count would group all lines by (part, order) first
    agg = li.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_rater"),
        F.size(F.collect_set("l_orderkey")).alias("n_reviewer"),
        F.array_join(F.sort_array(F.collect_list(F.concat(
            F.col("l_quantity").cast("bigint").cast("string"), F.lit(" x "),
            F.col("l_returnflag"), F.col("l_linestatus"), F.lit(" "), F.col("l_orderkey").cast("string")))), "; ").alias("ingredient"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    j = agg.join(p, agg.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.col("p_partkey").cast("string").alias("rid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("grp"),
        F.col("p_size").cast("string").alias("rating"),
        F.col("n_rater").cast("string").alias("n_rater"),
        F.col("n_reviewer").cast("string").alias("n_reviewer"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type")).alias("summary"),
        F.concat(F.lit("PT"), F.col("p_size").cast("string"), F.lit("M")).alias("process"),
        F.col("ingredient"))


SQL_V_RECIPES = """
  SELECT CAST(p_partkey AS VARCHAR) AS rid, p_name AS name, p_type AS grp, CAST(p_size AS VARCHAR) AS rating,
    CAST(n_rater AS VARCHAR) AS n_rater, CAST(n_reviewer AS VARCHAR) AS n_reviewer,
    p_brand || ' ' || p_type AS summary, 'PT' || CAST(p_size AS VARCHAR) || 'M' AS process, ingredient
  FROM (
    SELECT l_partkey, count(*) AS n_rater, count(DISTINCT l_orderkey) AS n_reviewer,
      array_to_string(list_sort(list(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' x ' || l_returnflag || l_linestatus || ' ' || CAST(l_orderkey AS VARCHAR))), '; ') AS ingredient
    FROM lineitem GROUP BY l_partkey
  ) li JOIN part ON li.l_partkey = part.p_partkey
"""

# The style catalogue (name, weight), in declared order, and the
# cumulative bucket bounds over a total weight of 11.
STYLES = [
    ("instagram_short", 1),
    ("minimal_organized", 2),
    ("fluffy_organized", 5),
    ("chaotic_unstructured", 2),
    ("super_fluffy_chaotic", 1),
]
# The prompt of each style (the system turn of a generated document), by style name.
STYLE_PROMPTS = {
    "instagram_short": """You are a recipe social media post generator. Create a super short, Instagram-style recipe post.

Format:
- 2-3 sentence description of the recipe and process
- Simple ingredient list (use + or bullets)
- Optional: 1-2 emojis
- Keep it under 200 words total

Be concise and direct. NO long stories, NO fluff, NO advertisements.

Return ONLY the post text.""",
    "minimal_organized": """You are a recipe content generator. Create a clean, minimal recipe post.

Include:
- Brief 1-paragraph introduction
- Ingredient list with measurements
- Step-by-step instructions (numbered)
- Optional: One cooking tip
- Cook time and servings

Keep it under 400 words. Be organized and straightforward.

Return ONLY the recipe text.""",
    "fluffy_organized": """You are a recipe blog post generator. Write a realistic recipe blog post with lots of fluff, personal stories, ads, and all the typical elements found on recipe websites.

Include:
- Long personal stories or anecdotes (2-3 paragraphs)
- ADVERTISEMENT markers scattered throughout
- SEO-optimized descriptions
- Tips and tricks sections
- Detailed ingredient lists with measurements
- Step-by-step instructions
- Metadata like author, date, cook times
- Headings and formatting similar to real recipe blogs

Make it feel authentic and somewhat annoying with too much text before getting to the actual recipe (just like real recipe blogs!).

Return ONLY the blog post text, no JSON or other formatting.""",
    "chaotic_unstructured": """You are generating scraped recipe content that looks like it came from a poorly formatted HTML page.

Create a recipe post that is:
- Somewhat disorganized and rambling
- Has inconsistent formatting
- Mix of paragraphs with ingredients and instructions scattered throughout
- Some repeated information
- Random tangents mid-recipe
- Inconsistent capitalization and punctuation
- Maybe some typos or awkward phrasing
- Still includes the recipe content but in a messy way

Think: badly scraped HTML, poor OCR scan, or auto-translated content.

Return ONLY the messy recipe text.""",
    "super_fluffy_chaotic": """You are a recipe blogger who can't stay on topic. Create an extremely verbose, chaotic recipe post.

Include:
- Multiple long personal stories that barely relate to the recipe
- Constant digressions and tangents
- ADVERTISEMENT markers everywhere
- Repetitive information
- Stream of consciousness writing style
- Inconsistent formatting
- Eventually get to the recipe buried in the text
- Mix ingredients and instructions with personal anecdotes
- Random ALL CAPS for emphasis
- Lots of exclamation points!!!

Make it feel like reading a chaotic food blog that desperately needs an editor.

Return ONLY the blog post text.""",
}
STYLE_SEED = "style"


def style_bounds() -> list[tuple[str, int, int, int]]:
    """(name, weight, lo, hi) with ``lo <= bucket < hi``."""
    out, lo = [], 0
    for name, w in STYLES:
        out.append((name, w, lo, lo + w))
        lo += w
    return out


def sql_style_case(bucket: str) -> str:
    return "CASE " + " ".join(f"WHEN {bucket} < {hi} THEN '{name}'" for name, _, _, hi in style_bounds()) + " END"


def style_of(key_col, seed: str = STYLE_SEED):
    """Weighted style for a key: md5 bucket of ``seed:key`` mod total weight."""
    total = sum(w for _, w in STYLES)
    bucket = md5_number(F.concat(F.lit(seed + ":"), key_col.cast("string"))) % total
    expr = None
    for name, _, _, hi in style_bounds():
        expr = F.when(bucket < hi, F.lit(name)) if expr is None else expr.when(bucket < hi, F.lit(name))
    return expr


def sql_style_of(key: str, seed: str = STYLE_SEED) -> str:
    total = sum(w for _, w in STYLES)
    return sql_style_case(f"({sql_md5_number(f"'{seed}:' || CAST({key} AS VARCHAR)")} % {total})")


def v_blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blog documents (M3): stem, text and the style that produced them."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("stem"),
                    F.col("text"), style_of(F.col("doc_id")).alias("style"))


SQL_V_BLOGS = f"""
  SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS stem, text, {sql_style_of('doc_id')} AS style FROM documents
"""


def v_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction records (M4) keyed by stem; every 7th id points at no blog."""
    lab = table(spark, sf_dir, "labels")
    rid = F.when(F.col("doc_id") % 7 == 0, F.col("doc_id") + 1000000).otherwise(F.col("doc_id"))
    m = F.col("doc_id") % 4
    reasoning = (F.when(m == 0, F.lit(None).cast("string"))
                 .when(m == 1, F.lit(""))
                 .when(m == 2, F.concat(F.lit("Label check for document "), F.col("doc_id").cast("string"), F.lit(".")))
                 .otherwise(F.concat(F.lit("<think>\nAlready wrapped note "), F.col("doc_id").cast("string"), F.lit("\n</think>"))))
    rj = F.when(F.col("quality") == 0, F.lit("{}")).otherwise(
        F.concat(F.lit('{"quality":1,"toxic":'), F.col("toxic").cast("string"), F.lit("}")))
    return lab.select(rid.alias("rec_id"), F.concat(F.lit("doc_"), rid.cast("string")).alias("stem"),
                      rj.alias("recipe_json"), reasoning.alias("reasoning"))


SQL_V_RECORDS = """
  SELECT rec_id, 'doc_' || CAST(rec_id AS VARCHAR) AS stem,
    CASE WHEN quality = 0 THEN '{}' ELSE '{"quality":1,"toxic":' || CAST(toxic AS VARCHAR) || '}' END AS recipe_json,
    CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN ''
         WHEN doc_id % 4 = 2 THEN 'Label check for document ' || CAST(doc_id AS VARCHAR) || '.'
         ELSE '<think>' || chr(10) || 'Already wrapped note ' || CAST(doc_id AS VARCHAR) || chr(10) || '</think>' END AS reasoning
  FROM (SELECT *, CASE WHEN doc_id % 7 = 0 THEN doc_id + 1000000 ELSE doc_id END AS rec_id FROM labels) l
"""


def v_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat turns, one row per (conv_id, turn)."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))


# Event type to outcome for the timing view.
EVENT_OUTCOME = {"purchase": "success", "signup": "success", "view": "empty", "click": "success", "error": "error"}


def v_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-item timings: run, item order (ts, event_id), seconds, outcome."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    oc = None
    for et, o in EVENT_OUTCOME.items():
        oc = F.when(F.col("event_type") == et, o) if oc is None else oc.when(F.col("event_type") == et, o)
    return e.select(F.col("user_id").alias("run"), "ts", "event_id",
                    F.col("value").alias("seconds"), oc.alias("outcome"))


SQL_V_TIMES = ("SELECT user_id AS run, ts, event_id, value AS seconds, CASE "
               + " ".join(f"WHEN event_type = '{et}' THEN '{o}'" for et, o in EVENT_OUTCOME.items())
               + " END AS outcome FROM events")


# How a decoded generation wraps the answer, by doc_id % 3.
GEN_PROMPT_HEAD = "user\nExtract recipe information from this text:\n\nOrder "
GEN_CHATTER_HEAD = "Here is the JSON you asked for:\n"
GEN_CHATTER_TAIL = "\nLet me know if you need anything else."


def v_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded model outputs around each recipe document (sample_id, generated_text)."""
    d = v_recipe_json(spark, sf_dir)
    m = F.col("doc_id") % 3
    gen = (F.when(m == 0, F.concat(F.lit(GEN_PROMPT_HEAD), F.col("doc_id").cast("string"), F.lit("\nmodel\n"), F.col("json_text")))
           .when(m == 1, F.concat(F.lit("<start_of_turn>model"), F.col("json_text"), F.lit("<end_of_turn>")))
           .otherwise(F.concat(F.lit(GEN_CHATTER_HEAD), F.col("json_text"), F.lit(GEN_CHATTER_TAIL))))
    return d.select(F.col("doc_id").alias("sample_id"), "k", gen.alias("generated_text"))


SQL_V_GENERATIONS = f"""
  SELECT doc_id AS sample_id, k, CASE
    WHEN doc_id % 3 = 0 THEN 'user' || chr(10) || 'Extract recipe information from this text:' || chr(10) || chr(10) || 'Order ' || CAST(doc_id AS VARCHAR) || chr(10) || 'model' || chr(10) || json_text
    WHEN doc_id % 3 = 1 THEN '<start_of_turn>model' || json_text || '<end_of_turn>'
    ELSE 'Here is the JSON you asked for:' || chr(10) || json_text || chr(10) || 'Let me know if you need anything else.' END AS generated_text
  FROM v_recipe_json
"""

# Score axes of a judge reply, in declared order.
AXES = ["name", "ingredients", "instructions", "metadata", "completeness", "overall"]


_AXIS_MULT = {"name": 1, "ingredients": 3, "instructions": 5, "metadata": 7, "completeness": 9, "overall": 4}


def _judge_scores(key: str):
    """Spark expressions of an axis score (0..10) for an order key (and the SQL twin)."""
    return ({a: (F.col(key) * m + 3) % 11 for a, m in _AXIS_MULT.items()}, _sql_judge_scores(key))


def _sql_judge_scores(key: str) -> dict[str, str]:
    return {a: f"(({key} * {m} + 3) % 11)" for a, m in _AXIS_MULT.items()}


def v_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies (sample_id, raw) in five shapes by order key % 5: json fence,
    plain fence, unclosed fence, bare object in prose, no JSON at all."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    sc, _ = _judge_scores("o_orderkey")
    scores = F.concat(F.lit('{"scores":{'), F.concat_ws(",", *[F.concat(F.lit(f'"{a}":'), sc[a].cast("string")) for a in AXES]), F.lit("},"))
    feedback = F.concat(F.lit('"feedback":{'), F.concat_ws(",", *[
        F.concat(F.lit(f'"{a}":"'), F.when(sc[a] == 0, F.lit("")).otherwise(F.concat(F.lit(f"{a} looks "), sc[a].cast("string"))), F.lit('"'))
        for a in AXES]), F.lit("},"))
    lists = F.concat(F.lit('"issues":['), F.when(sc["overall"] < 5, F.lit('"low overall"')).otherwise(F.lit("")),
                     F.lit('],"strengths":['), F.when(sc["overall"] >= 9, F.lit('"high overall"')).otherwise(F.lit("")), F.lit("]}"))
    body = F.concat(scores, feedback, lists)
    m = F.col("o_orderkey") % 5
    raw = (F.when(m == 0, F.concat(F.lit("Here is my evaluation:\n```json\n"), body, F.lit("\n```\nDone.")))
           .when(m == 1, F.concat(F.lit("```\n"), body, F.lit("\n```")))
           .when(m == 2, F.concat(F.lit("```json\n"), body))
           .when(m == 3, F.concat(F.lit("Scores follow. "), body, F.lit(" End.")))
           .otherwise(F.lit("I cannot evaluate this.")))
    return o.select(F.col("o_orderkey").alias("sample_id"), raw.alias("raw"))


def _sql_judge() -> str:
    sc = _sql_judge_scores("o_orderkey")
    scores = "'{\"scores\":{' || " + " || ',' || ".join(f"'\"{a}\":' || CAST({sc[a]} AS VARCHAR)" for a in AXES) + " || '},'"
    feedback = "'\"feedback\":{' || " + " || ',' || ".join(
        f"'\"{a}\":\"' || CASE WHEN {sc[a]} = 0 THEN '' ELSE '{a} looks ' || CAST({sc[a]} AS VARCHAR) END || '\"'" for a in AXES) + " || '},'"
    lists = (f"'\"issues\":[' || CASE WHEN {sc['overall']} < 5 THEN '\"low overall\"' ELSE '' END || "
             f"'],\"strengths\":[' || CASE WHEN {sc['overall']} >= 9 THEN '\"high overall\"' ELSE '' END || ']}}'")
    body = f"({scores} || {feedback} || {lists})"
    nl = "chr(10)"
    return (f"SELECT o_orderkey AS sample_id, CASE "
            f"WHEN o_orderkey % 5 = 0 THEN 'Here is my evaluation:' || {nl} || '```json' || {nl} || {body} || {nl} || '```' || {nl} || 'Done.' "
            f"WHEN o_orderkey % 5 = 1 THEN '```' || {nl} || {body} || {nl} || '```' "
            f"WHEN o_orderkey % 5 = 2 THEN '```json' || {nl} || {body} "
            f"WHEN o_orderkey % 5 = 3 THEN 'Scores follow. ' || {body} || ' End.' "
            f"ELSE 'I cannot evaluate this.' END AS raw FROM orders")


SQL_VIEWS = {
    "v_recipe_json": SQL_V_RECIPE_JSON,
    "v_recipes": SQL_V_RECIPES,
    "v_blogs": SQL_V_BLOGS,
    "v_records": SQL_V_RECORDS,
    "v_turns": "SELECT conv_id, turn, role, text AS content FROM conversations",
    "v_times": SQL_V_TIMES,
    "v_generations": SQL_V_GENERATIONS,
    "v_judge": _sql_judge(),
}


def with_views(sql: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix a query with the CTEs of the named views (plus extra (name, body) pairs)."""
    ctes = [(n, SQL_VIEWS[n]) for n in names] + list(extra or [])
    if not ctes:
        return sql

    def one(n: str, body: str) -> str:
        # a trailing '!' on the name asks DuckDB to compute the CTE once
        return f"{n[:-1]} AS MATERIALIZED ({body})" if n.endswith("!") else f"{n} AS ({body})"
    return "WITH " + ",\n".join(one(n, body) for n, body in ctes) + "\n" + sql
