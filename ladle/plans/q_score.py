"""Queries: synthesis, extraction, scoring, judge replies and the evaluation report
(I1-I7, E6, E7, F7, A9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions import text as T
from ladle.operators import score as SC
from ladle.operators import split as SP
from ladle.operators import summary as S
from ladle.operators import synth as SY
from ladle.operators.validate import sql_validate_ctes, validate
from ladle.plans.catalog import register
from ladle.plans.views import STYLE_SEED, sql_style_of, style_of, v_generations, v_judge, v_recipe_json, v_recipes, with_views
from ladle.session import scratch_dir
from ladle.sources import io as IO

NL = "chr(10)"
BATCH = 48
PER_BATCH = 2
RUN = {"model_name": "ladle-eval", "batch_size": BATCH, "vibes_samples_per_batch": PER_BATCH, "vibes_model": "rule-scorer"}


# --- I1 / I2 -------------------------------------------------------------------

def _docs(spark, sf_dir) -> DataFrame:
    r = v_recipes(spark, sf_dir).withColumn("style", style_of(F.col("rid")))
    return SY.synthesize(r)


def _sql_shuffled(lst: str) -> str:
    return f"list_transform(list_sort(list_transform({lst}, lambda x: {{'h': md5('{SY.SYNTH_SEED}:' || x), 'l': x}})), lambda s: s.l)"


def _sql_cat(*lists: str) -> str:
    out = lists[0]
    for x in lists[1:]:
        out = f"list_concat({out}, {x})"
    return out


_I = "list_transform(string_split(ingredient, '; '), lambda x: '- ' || x)"
_S = "list_transform(string_split(ingredient, '; '), lambda x, i: CAST(i AS VARCHAR) || '. Add ' || x)"
_MY = f"""['Time: ' || process, 'Serves: ' || n_rater, 'Category: ' || grp,
  'Prep: ' || {SY.PREP_SQL}, 'Cook: ' || {SY.COOK_SQL}, 'Cuisine: ' || {SY.CUISINE_SQL}]"""
_STORIES = "[" + ", ".join(
    " || ".join(p.strip("{}") if p.startswith("{") else T.sql_str(p) for p in SY._tokens(line)) for line in SY.STORY_LINES) + "]"
_FLUFFY_REST = _sql_cat(_STORIES, "['ADVERTISEMENT']", _I, "['ADVERTISEMENT']", _S, _MY)
_SQL_LINES = ("CASE style "
              f"WHEN 'instagram_short' THEN {_sql_cat('[name, summary]', _I)} "
              f"WHEN 'minimal_organized' THEN {_sql_cat('[name, summary]', _I, _S, _MY)} "
              f"WHEN 'fluffy_organized' THEN {_sql_cat('[name]', _FLUFFY_REST)} "
              f"WHEN 'chaotic_unstructured' THEN {_sql_cat('[name]', _sql_shuffled(_sql_cat('[summary]', _I, _I, _S, _MY)))} "
              f"WHEN 'super_fluffy_chaotic' THEN {_sql_cat('[upper(name)]', f'flatten(list_transform({_sql_shuffled(_FLUFFY_REST)}, lambda x: [x, {chr(39)}ADVERTISEMENT{chr(39)}]))')} "
              "END")
_SQL_DOCS = ("docs", f"SELECT *, '{SY.HEADER_PREFIX}' || style || '{SY.HEADER_SUFFIX}' || {NL} || {NL} || body AS text FROM ("
                     f"SELECT *, array_to_string({_SQL_LINES}, {NL}) AS body FROM ("
                     f"SELECT *, {sql_style_of('rid', STYLE_SEED)} AS style FROM v_recipes))")


@register("synthesize_docs", with_views("SELECT rid, style, text FROM docs", "v_recipes", extra=[_SQL_DOCS]))
def synthesize_docs(spark, sf_dir):
    """A styled document for every source record."""
    return _docs(spark, sf_dir).select("rid", "style", "text")


_STEP_RE = T.sql_str(SY.STEP_RE)
_SQL_X = ("xdocs", f"""SELECT rid, lines[1] AS x_name,
  list_sort(list_distinct(list_transform(list_filter(lines, lambda l: regexp_matches(l, {T.sql_str(SY.INGREDIENT_RE)})),
    lambda l: regexp_extract(l, {T.sql_str(SY.INGREDIENT_RE)}, 1)))) AS x_ingredients,
  list_transform(list_sort(list_transform(list_filter(lines, lambda l: regexp_matches(l, {_STEP_RE})),
    lambda l: {{'n': CAST(regexp_extract(l, {_STEP_RE}, 1) AS BIGINT), 't': regexp_extract(l, {_STEP_RE}, 2)}})), lambda s: s.t) AS x_steps,
  regexp_extract(list_filter(lines, lambda l: regexp_matches(l, {T.sql_str(SY.TIME_RE)}))[1], {T.sql_str(SY.TIME_RE)}, 1) AS x_total_time,
  regexp_extract(list_filter(lines, lambda l: regexp_matches(l, {T.sql_str(SY.YIELD_RE)}))[1], {T.sql_str(SY.YIELD_RE)}, 1) AS x_yield,
  regexp_extract(list_filter(lines, lambda l: regexp_matches(l, {T.sql_str(SY.CATEGORY_RE)}))[1], {T.sql_str(SY.CATEGORY_RE)}, 1) AS x_category,
  regexp_extract(list_filter(lines, lambda l: regexp_matches(l, {T.sql_str(SY.PREP_RE)}))[1], {T.sql_str(SY.PREP_RE)}, 1) AS x_prep_time,
  regexp_extract(list_filter(lines, lambda l: regexp_matches(l, {T.sql_str(SY.COOK_RE)}))[1], {T.sql_str(SY.COOK_RE)}, 1) AS x_cook_time,
  regexp_extract(list_filter(lines, lambda l: regexp_matches(l, {T.sql_str(SY.CUISINE_RE)}))[1], {T.sql_str(SY.CUISINE_RE)}, 1) AS x_cuisine
FROM (SELECT rid, string_split(CASE WHEN starts_with(text, '{SY.HEADER_PREFIX}')
  THEN regexp_replace(text, '^<!-- Generated with style: [^\\n]* -->\\n\\n?', '') ELSE text END, {NL}) AS lines FROM docs)""")

_SQL_XJSON = ("'{\"@context\":\"https://schema.org\",\"@type\":\"Recipe\"' "
              "|| CASE WHEN x_name IS NOT NULL THEN ',\"name\":' || to_json(x_name)::VARCHAR ELSE '' END "
              "|| CASE WHEN len(x_ingredients) > 0 THEN ',\"recipeIngredient\":' || to_json(x_ingredients)::VARCHAR ELSE '' END "
              "|| CASE WHEN len(x_steps) > 0 THEN ',\"recipeInstructions\":[' || array_to_string(list_transform(x_steps, "
              "lambda t: '{\"@type\":\"HowToStep\",\"text\":' || to_json(t)::VARCHAR || '}'), ',') || ']' ELSE '' END "
              "|| CASE WHEN x_prep_time IS NOT NULL THEN ',\"prepTime\":' || to_json(x_prep_time)::VARCHAR ELSE '' END "
              "|| CASE WHEN x_cook_time IS NOT NULL THEN ',\"cookTime\":' || to_json(x_cook_time)::VARCHAR ELSE '' END "
              "|| CASE WHEN x_total_time IS NOT NULL THEN ',\"totalTime\":' || to_json(x_total_time)::VARCHAR ELSE '' END "
              "|| CASE WHEN x_yield IS NOT NULL THEN ',\"recipeYield\":' || to_json(x_yield)::VARCHAR ELSE '' END "
              "|| CASE WHEN x_category IS NOT NULL THEN ',\"recipeCategory\":' || to_json(x_category)::VARCHAR ELSE '' END "
              "|| CASE WHEN x_cuisine IS NOT NULL THEN ',\"recipeCuisine\":' || to_json(x_cuisine)::VARCHAR ELSE '' END || '}'")


def _extracted(spark, sf_dir) -> DataFrame:
    return SY.extract_record(_docs(spark, sf_dir).select("rid", "text"))


@register("extract_records", with_views(
    f"SELECT rid, x_name, CAST(len(x_ingredients) AS INTEGER) AS n_ingredients, CAST(len(x_steps) AS INTEGER) AS n_steps, "
    f"x_total_time, x_yield, x_category, {_SQL_XJSON} AS recipe_json FROM xdocs", "v_recipes", extra=[_SQL_DOCS, _SQL_X]))
def extract_records(spark, sf_dir):
    """Each synthesized document read back into a recipe JSON document."""
    x = _extracted(spark, sf_dir)
    return x.select("rid", "x_name", F.size("x_ingredients").alias("n_ingredients"), F.size("x_steps").alias("n_steps"),
                    "x_total_time", "x_yield", "x_category", "recipe_json")


# --- I3 / I4 -------------------------------------------------------------------

def _scores(spark, sf_dir) -> DataFrame:
    """The extraction table joined to the source table by key, then the six axes."""
    x = SY.extract_record(_docs(spark, sf_dir).select("rid", "text")).select(
        "rid", "x_name", "x_ingredients", "x_steps", "x_total_time", "x_yield", "x_category", "x_prep_time", "x_cook_time", "x_cuisine")
    both = SC.compare(v_recipes(spark, sf_dir), x, "rid")
    ings = F.split("ingredient", "; ")
    # prepTime, cookTime, totalTime, recipeYield, recipeCategory, recipeCuisine
    scored = SC.add_scores(both, F.col("name"), ings, F.transform(ings, lambda v: F.concat(F.lit("Add "), v)),
                           [F.expr(SY.PREP_SQL), F.expr(SY.COOK_SQL), F.col("process"), F.col("n_rater"), F.col("grp"), F.expr(SY.CUISINE_SQL)],
                           F.col("x_name"), F.col("x_ingredients"), F.col("x_steps"),
                           [F.col(f"x_{c}") for c in ("prep_time", "cook_time", "total_time", "yield", "category", "cuisine")])
    return scored.select("rid", "scores")


def _sql_ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END"


def _sql_words(e: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array(lower({e}), '\\s+'), lambda w: w <> ''))"


_META_S = [SY.PREP_SQL, SY.COOK_SQL, "process", "n_rater", "grp", SY.CUISINE_SQL]
_META_X = ["x_prep_time", "x_cook_time", "x_total_time", "x_yield", "x_category", "x_cuisine"]
_SQL_SCORE_PARTS = ("sparts", f"""SELECT rid,
  {_sql_words('name')} AS a, {_sql_words('x_name')} AS b,
  list_distinct(string_split(ingredient, '; ')) AS si, list_distinct(x_ingredients) AS xi,
  list_transform(string_split(ingredient, '; '), lambda v: 'Add ' || v) AS ss, x_steps AS xs,
  {' + '.join(f'CASE WHEN ({s}) IS NOT NULL THEN 1 ELSE 0 END' for s in _META_S)} AS present,
  {' + '.join(f'CASE WHEN ({s}) IS NOT NULL AND ({s}) = {x} THEN 1 ELSE 0 END' for s, x in zip(_META_S, _META_X))} AS equal,
  list_filter([{', '.join(f"'m{i}:' || {s}" for i, s in enumerate(_META_S))}], lambda v: v IS NOT NULL) AS ms,
  list_filter([{', '.join(f"'m{i}:' || {x}" for i, x in enumerate(_META_X))}], lambda v: v IS NOT NULL) AS mx
FROM v_recipes JOIN xdocs USING (rid)""")
_SQL_SCORE_PARTS2 = ("sparts2", """SELECT *, list_filter(ss, lambda s: list_contains(xs, s)) AS found FROM sparts""")
_SQL_SCORE_PARTS3 = ("sparts3", """SELECT *, list_transform(found, lambda s: list_position(xs, s)) AS pos,
  list_distinct(list_concat(list_concat(list_concat(list_transform(a, lambda w: 'name:' || w), list_transform(si, lambda v: 'ingredient:' || v)),
    list_transform(ss, lambda v: 'step:' || v)), ms)) AS pairs_s,
  list_distinct(list_concat(list_concat(list_concat(list_transform(b, lambda w: 'name:' || w), list_transform(xi, lambda v: 'ingredient:' || v)),
    list_transform(xs, lambda v: 'step:' || v)), mx)) AS pairs_x FROM sparts2""")
_SQL_SCORE_RAW = ("sraw", f"""SELECT rid,
  10.0 * {_sql_ratio('len(list_intersect(a, b))', 'len(list_distinct(list_concat(a, b)))')} AS s_name,
  10.0 * {_sql_ratio('len(list_intersect(si, xi))', 'len(si)')} AS s_ingredients,
  10.0 * {_sql_ratio('len(found)', 'len(ss)')} * CASE WHEN len(found) < 2 THEN 1.0 ELSE
    CAST(len(list_filter(list_transform(range(2, len(pos) + 1), lambda k: pos[k] > pos[k - 1]), lambda ok: ok)) AS DOUBLE) / CAST(len(found) - 1 AS DOUBLE) END AS s_instructions,
  10.0 * {_sql_ratio('equal', 'present')} AS s_metadata,
  {_sql_ratio('len(list_intersect(pairs_s, pairs_x))', 'len(pairs_x)')} AS p,
  {_sql_ratio('len(list_intersect(pairs_s, pairs_x))', 'len(pairs_s)')} AS r
FROM sparts3""")
_SQL_SCORES = ("scores", """SELECT rid, round(s_name, 6) AS name, round(s_ingredients, 6) AS ingredients, round(s_instructions, 6) AS instructions,
  round(s_metadata, 6) AS metadata, round(s_completeness, 6) AS completeness,
  round((s_name + s_ingredients + s_instructions + s_metadata + s_completeness) / 5.0, 6) AS overall
FROM (SELECT *, 10.0 * CASE WHEN (p + r) > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS s_completeness FROM sraw)""")
_SCORE_CTES = [_SQL_DOCS, _SQL_X, _SQL_SCORE_PARTS, _SQL_SCORE_PARTS2, _SQL_SCORE_PARTS3, _SQL_SCORE_RAW, _SQL_SCORES]


@register("score_axes", with_views("SELECT rid, " + ", ".join(SC.AXES) + " FROM scores", "v_recipes", extra=_SCORE_CTES))
def score_axes(spark, sf_dir):
    """I3 + E7 + I8: six axis scores of every extraction against its source record."""
    s = _scores(spark, sf_dir)
    return s.select("rid", *[F.col(f"scores.{a}").alias(a) for a in SC.AXES])


_SQL_FINDINGS = ("array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {a} < {SC.ISSUE_BELOW} THEN '{a} score below {SC.ISSUE_BELOW:g}' END" for a in SC.AXES) + "], lambda x: x IS NOT NULL), '; ') AS issues, "
    "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {a} >= {SC.STRENGTH_FROM} THEN '{a} score {SC.STRENGTH_FROM:g} or more' END" for a in SC.AXES) + "], lambda x: x IS NOT NULL), '; ') AS strengths")


@register("score_findings", with_views(f"SELECT rid, {_SQL_FINDINGS} FROM scores", "v_recipes", extra=_SCORE_CTES))
def score_findings(spark, sf_dir):
    """I4: issues (axis below 5) and strengths (axis 9 or more) per extraction."""
    s = _scores(spark, sf_dir)
    issues, strengths = SC.findings(F.col("scores"))
    return s.select("rid", F.array_join(issues, "; ").alias("issues"), F.array_join(strengths, "; ").alias("strengths"))


# --- I5 / I6 / I7 / E6 / F7 / A9 ----------------------------------------------------

def _judged(spark, sf_dir) -> DataFrame:
    return SC.normalize_judge(v_judge(spark, sf_dir))


def _sql_judged() -> list[tuple[str, str]]:
    from ladle.operators.validate import sql_tolerant_ctes
    fj = T.sql_fenced_json("raw")
    src = ("jraw", f"SELECT sample_id, raw, {fj} AS js FROM v_judge")
    return [src] + sql_tolerant_ctes("jraw", "sample_id, raw, js", "js", out="jparsed") + [("judged", f"""
  SELECT sample_id, CASE WHEN js IS NULL THEN '{T.NO_JSON_ERROR}' WHEN outcome = 'rejected' THEN '{SC.PARSE_ERROR}' END AS error,
    {', '.join(f'TRY_CAST(json_extract(json_text, {chr(39)}$.scores.{a}{chr(39)}) AS DOUBLE) AS score_{a}' for a in SC.AXES)},
    {', '.join(f'json_extract_string(json_text, {chr(39)}$.feedback.{a}{chr(39)}) AS feedback_{a}' for a in SC.AXES)},
    coalesce(array_to_string(CAST(json_extract(json_text, '$.issues') AS VARCHAR[]), '; '), '') AS issues,
    coalesce(array_to_string(CAST(json_extract(json_text, '$.strengths') AS VARCHAR[]), '; '), '') AS strengths,
    raw
  FROM jparsed""")]


@register("judge_normalize", with_views(
    "SELECT sample_id, error, " + ", ".join(f"score_{a}" for a in SC.AXES) + ", " + ", ".join(f"feedback_{a}" for a in SC.AXES)
    + ", issues, strengths, CASE WHEN error IS NOT NULL THEN raw END AS raw FROM judged", "v_judge", extra=_sql_judged()))
def judge_normalize(spark, sf_dir):
    """Every judge reply as scores / feedback / issues / strengths, or an error with the raw text."""
    j = _judged(spark, sf_dir)
    return j.select("sample_id", "judge.error", *[F.col(f"judge.scores.{a}").alias(f"score_{a}") for a in SC.AXES],
                    *[F.col(f"judge.feedback.{a}").alias(f"feedback_{a}") for a in SC.AXES],
                    F.array_join("judge.issues", "; ").alias("issues"), F.array_join("judge.strengths", "; ").alias("strengths"),
                    "judge.raw")


@register("score_report", with_views(
    "SELECT sample_id, CAST(pos AS INTEGER) AS pos, axis, label, coalesce(score, 0.0) AS score, CASE WHEN feedback <> '' THEN feedback END AS feedback FROM ("
    + " UNION ALL ".join(f"SELECT sample_id, {i} AS pos, '{a}' AS axis, '{a.capitalize()}' AS label, score_{a} AS score, feedback_{a} AS feedback FROM judged"
                         for i, a in enumerate(SC.AXES)) + ")", "v_judge", extra=_sql_judged()))
def score_report(spark, sf_dir):
    """Long-form score report (missing score -> 0, empty feedback -> NULL)."""
    return SC.score_report(_judged(spark, sf_dir), "sample_id")


_SQL_SAMPLES = ("samples", f"""SELECT doc_id AS sample_id, pos - 1 AS idx, CAST(floor((pos - 1) / {BATCH}) AS BIGINT) + 1 AS batch_num
  FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS pos FROM v_recipe_json)""")
_SQL_ATTACHED = ("attached", f"""SELECT s.sample_id, s.batch_num, (j.sample_id IS NOT NULL) AS evaluated, j.score_overall AS overall, j.error AS judge_error
  FROM samples s LEFT JOIN (SELECT * FROM judged WHERE sample_id IN (
    SELECT sample_id FROM (SELECT sample_id, row_number() OVER (PARTITION BY batch_num ORDER BY idx) AS rn FROM samples) WHERE rn <= {PER_BATCH})) j
  ON s.sample_id = j.sample_id""")


def _attached(spark, sf_dir) -> DataFrame:
    samples = SP.with_batch(v_recipe_json(spark, sf_dir).select(F.col("doc_id").alias("sample_id")), ["sample_id"], BATCH, idx="idx")
    picked = SP.first_n_per_batch(samples, PER_BATCH, BATCH, idx="idx").select("sample_id")
    judged = _judged(spark, sf_dir).join(picked, "sample_id", "left_semi").select(
        "sample_id", F.lit(True).alias("evaluated"), F.col("judge.scores.overall").alias("overall"), F.col("judge.error").alias("judge_error"))
    from ladle.operators.pairing import attach_scores as attach
    out = attach(samples.select("sample_id", "batch_num"), judged)
    return out.withColumn("evaluated", F.coalesce("evaluated", F.lit(False)))


_ATT = ["v_judge", "v_recipe_json"]


@register("sampled_scores", with_views(
    "SELECT sample_id, batch_num, overall, judge_error FROM attached WHERE evaluated", *_ATT,
    extra=_sql_judged() + [_SQL_SAMPLES, _SQL_ATTACHED]))
def sampled_scores(spark, sf_dir):
    """The judge results of the first two samples of every batch."""
    return _attached(spark, sf_dir).filter("evaluated").select("sample_id", "batch_num", "overall", "judge_error")


@register("attach_scores", with_views(
    "SELECT sample_id, batch_num, evaluated, overall, judge_error FROM attached", *_ATT,
    extra=_sql_judged() + [_SQL_SAMPLES, _SQL_ATTACHED]))
def attach_scores(spark, sf_dir):
    """Every sample with its judge result where one was taken (NULL elsewhere)."""
    return _attached(spark, sf_dir).select("sample_id", "batch_num", "evaluated", "overall", "judge_error")


_SQL_SCORE_SUMMARY = ("count(*) FILTER (WHERE evaluated) AS vibes_evaluated_count, round(avg(overall), 6) AS vibes_avg_score, "
                      "round(min(overall), 6) AS vibes_min_score, round(max(overall), 6) AS vibes_max_score")


@register("score_summary", with_views(f"SELECT {_SQL_SCORE_SUMMARY} FROM attached", *_ATT,
                                      extra=_sql_judged() + [_SQL_SAMPLES, _SQL_ATTACHED]))
def score_summary(spark, sf_dir):
    """evaluated count and avg / min / max overall score."""
    return S.score_summary(_attached(spark, sf_dir))


def _gen_validated(spark, sf_dir) -> DataFrame:
    g = v_generations(spark, sf_dir).select(F.col("sample_id").alias("doc_id"), "k",
                                            T.extract_answer_json("generated_text").alias("json_text"))
    return validate(g, "json_text", warnings=False)


_SQL_GEN_JSON = ("gen_json", f"SELECT sample_id AS doc_id, k, {T.sql_extract_answer_json('generated_text')} AS json_text FROM v_generations")


@register("eval_report", with_views(
    "SELECT " + ", ".join(f"{T.sql_str(v) if isinstance(v, str) else v} AS {k}" for k, v in RUN.items()) + ", v.*, s.* FROM "
    "(SELECT count(*) AS total_samples, count(*) FILTER (WHERE len(errors) = 0) AS valid_count, count(*) FILTER (WHERE len(errors) > 0) AS invalid_count, "
    "CASE WHEN count(*) > 0 THEN round(CAST(count(*) FILTER (WHERE len(errors) = 0) AS DOUBLE) * 100.0 / count(*), 6) ELSE 0.0 END AS valid_percentage FROM validated) v, "
    f"(SELECT {_SQL_SCORE_SUMMARY} FROM attached) s",
    "v_recipe_json", "v_generations", "v_judge",
    extra=[_SQL_GEN_JSON] + sql_validate_ctes("gen_json", "doc_id, k", "json_text") + _sql_judged() + [_SQL_SAMPLES, _SQL_ATTACHED]))
def eval_report(spark, sf_dir):
    """The evaluation report summary row: run metadata, validation and score summaries."""
    summary = S.eval_summary(_gen_validated(spark, sf_dir))
    scores = S.score_summary(_attached(spark, sf_dir))
    meta = [F.lit(v).alias(k) for k, v in RUN.items()]
    # both sides are single-row aggregates: the join on a constant key is 1 x 1
    one = F.lit(1).alias("_one")
    return (summary.select("*", one).join(scores.select("*", one), "_one")
                   .select(*meta, *summary.columns, *scores.columns))


_SQL_REPORT_SAMPLES = f"""SELECT a.sample_id, a.batch_num, g.json_text AS generated_json, len(v.errors) = 0 AS is_valid,
  array_to_string(v.errors, '; ') AS errors, array_to_string(v.warnings, '; ') AS warnings,
  a.evaluated, a.overall, CASE WHEN a.evaluated THEN j.raw END AS raw_response
FROM attached a JOIN gen_json g ON g.doc_id = a.sample_id JOIN validated v ON v.doc_id = a.sample_id LEFT JOIN judged j ON j.sample_id = a.sample_id"""


_REPORT_CTES = [_SQL_GEN_JSON] + sql_validate_ctes("gen_json", "doc_id, k", "json_text") + _sql_judged() + [_SQL_SAMPLES, _SQL_ATTACHED]


def _report(spark, sf_dir) -> str:
    """The report's tables, written once: its path."""
    g = v_generations(spark, sf_dir).select("sample_id", T.extract_answer_json("generated_text").alias("generated_json"))
    batches = SP.with_batch(v_recipe_json(spark, sf_dir).select(F.col("doc_id").alias("sample_id")), ["sample_id"], BATCH, idx="idx")
    picked = SP.first_n_per_batch(batches, PER_BATCH, BATCH, idx="idx").select("sample_id")
    raw = v_judge(spark, sf_dir).join(picked, "sample_id", "left_semi")
    judged = SC.normalize_judge(raw).select("sample_id", "judge", F.col("raw").alias("raw_response"))
    samples = S.report_samples(validate(g, "generated_json"), batches.select("sample_id", "batch_num"), judged)
    path = scratch_dir(spark, "report")
    # the summary comes from the samples as written, so that they are validated once
    IO.write_report(path, S.run_row(spark, RUN), samples, lambda written: S.eval_summary(written.select("structural_validation.is_valid")))
    return path


def _flat(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", "batch_num", "generated_json", "structural_validation.is_valid",
                          F.array_join("structural_validation.errors", "; ").alias("errors"),
                          F.array_join("structural_validation.warnings", "; ").alias("warnings"),
                          F.col("vibes_evaluation").isNotNull().alias("evaluated"),
                          F.col("vibes_evaluation.evaluation.scores.overall").alias("overall"),
                          F.col("vibes_evaluation.raw_response").alias("raw_response"))


@register("eval_samples", with_views(_SQL_REPORT_SAMPLES, "v_recipe_json", "v_generations", "v_judge", extra=_REPORT_CTES))
def eval_samples(spark, sf_dir):
    """The report's samples with nested validation and judge result, written, read back and flattened."""
    _, back, _ = IO.read_report(spark, _report(spark, sf_dir))
    return _flat(back)


@register("eval_document", with_views(_SQL_REPORT_SAMPLES, "v_recipe_json", "v_generations", "v_judge", extra=_REPORT_CTES))
def eval_document(spark, sf_dir):
    """The whole report as one nested JSON document in parts that many tasks write; its samples read back and flattened."""
    run, samples, summary = IO.read_report(spark, _report(spark, sf_dir))
    path = scratch_dir(spark, "report-document")
    # the text is many times the tables that it comes from
    IO.write_report_document(path, run, samples, summary, packed=True)
    return _flat(IO.read_report_document(spark, path, samples.schema))
