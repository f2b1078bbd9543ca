"""Queries: pairing joins, style sampling, routing and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions import text as T
from ladle.operators import pairing as P
from ladle.operators import summary as S
from ladle.operators.route import GOOD, outcome, sql_outcome
from ladle.plans.catalog import register
from ladle.plans.views import STYLE_PROMPTS, STYLES, STYLE_SEED, style_bounds, table, v_blogs, v_records, v_times, with_views

_SQL_CATALOGUE = ("catalogue", " UNION ALL ".join(
    f"SELECT '{n}' AS style, {w} AS weight, {T.sql_text(STYLE_PROMPTS[n])} AS prompt, {lo} AS lo, {hi} AS hi" for n, w, lo, hi in style_bounds()))


@register("pair_join", with_views(
    "SELECT r.stem, r.rec_id, b.style, CAST(length(b.text) AS BIGINT) AS n_chars, r.recipe_json "
    "FROM v_records r JOIN v_blogs b ON r.stem = b.stem", "v_blogs", "v_records"))
def pair_join(spark, sf_dir):
    """Extraction records joined to their blog by stem."""
    p = P.pair(v_records(spark, sf_dir), v_blogs(spark, sf_dir))
    return p.select("stem", "rec_id", "style", F.length("text").cast("bigint").alias("n_chars"), "recipe_json")


@register("pair_anti", with_views(
    "SELECT rec_id, stem FROM v_records r WHERE NOT EXISTS (SELECT 1 FROM v_blogs b WHERE b.stem = r.stem)",
    "v_blogs", "v_records"))
def pair_anti(spark, sf_dir):
    """Records with no blog (reported and counted)."""
    return P.unpaired(v_records(spark, sf_dir), v_blogs(spark, sf_dir)).select("rec_id", "stem")


@register("style_lookup", with_views(
    "SELECT b.stem, b.style, c.weight, c.prompt FROM v_blogs b LEFT JOIN catalogue c ON b.style = c.style",
    "v_blogs", extra=[_SQL_CATALOGUE]))
def style_lookup(spark, sf_dir):
    """Every blog with its style's weight and prompt (broadcast of a fixed table)."""
    return P.with_style(v_blogs(spark, sf_dir), spark).select("stem", "style", "weight", "prompt")


_TOTAL_WEIGHT = sum(w for _, w in STYLES)


@register("weighted_style", with_views(
    f"SELECT doc_id, bucket, c.style, c.weight FROM (SELECT doc_id, "
    f"{T.sql_md5_number(f"'{STYLE_SEED}:' || CAST(doc_id AS VARCHAR)")} % {_TOTAL_WEIGHT} AS bucket FROM documents) d "
    "JOIN catalogue c ON d.bucket >= c.lo AND d.bucket < c.hi", extra=[_SQL_CATALOGUE]))
def weighted_style(spark, sf_dir):
    """D5 + E4: seeded weighted style per document via a range join on cumulative weights."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    d = d.withColumn("bucket", T.md5_number(F.concat(F.lit(STYLE_SEED + ":"), F.col("doc_id").cast("string"))) % _TOTAL_WEIGHT)
    return P.weighted_pick(d, spark, "bucket").select("doc_id", "bucket", "style", "weight")


@register("pending_anti", with_views(
    "SELECT stem FROM v_blogs b WHERE NOT EXISTS (SELECT 1 FROM v_records r WHERE r.stem = b.stem)",
    "v_blogs", "v_records"))
def pending_anti(spark, sf_dir):
    """E5: blogs that have no extraction record yet (what a resumed run must still do)."""
    return P.pending(v_blogs(spark, sf_dir).select("stem"), v_records(spark, sf_dir), "stem")


@register("outcome_route", with_views(f"SELECT rec_id, {sql_outcome()} AS outcome FROM v_records", "v_records"))
def outcome_route(spark, sf_dir):
    """Every extraction routed failed / empty / error / good."""
    return v_records(spark, sf_dir).select("rec_id", outcome().alias("outcome"))


@register("style_distribution", with_views(
    "SELECT style, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS percentage "
    "FROM v_blogs GROUP BY style", "v_blogs"))
def style_distribution(spark, sf_dir):
    """F1 + D9: style counts and shares over all blogs, largest first."""
    return S.style_distribution(v_blogs(spark, sf_dir))


@register("outcome_counts_gen", with_views(
    "SELECT count(*) FILTER (WHERE outcome = 'success') AS success_count, "
    "count(*) FILTER (WHERE outcome <> 'success') AS error_count, count(*) AS total FROM v_times", "v_times"))
def outcome_counts_gen(spark, sf_dir):
    """generation counters (anything but a success is an error)."""
    t = v_times(spark, sf_dir).withColumn("gen", F.when(F.col("outcome") == "success", "success").otherwise("error"))
    return S.outcome_counts(t, "gen", ("success", "error"))


@register("outcome_counts_extract", with_views(
    "SELECT count(*) FILTER (WHERE outcome = 'success') AS success_count, count(*) FILTER (WHERE outcome = 'empty') AS empty_count, "
    "count(*) FILTER (WHERE outcome = 'error') AS error_count, count(*) AS total FROM v_times", "v_times"))
def outcome_counts_extract(spark, sf_dir):
    """extraction counters."""
    return S.outcome_counts(v_times(spark, sf_dir), "outcome", ("success", "empty", "error"))


@register("outcome_counts_pair", with_views(
    "SELECT count(*) FILTER (WHERE o = 'matched') AS matched_count, count(*) FILTER (WHERE o = 'missing') AS missing_count, "
    "count(*) FILTER (WHERE o = 'error') AS error_count, count(*) AS total FROM ("
    f"SELECT CASE WHEN b.stem IS NULL THEN 'missing' WHEN {sql_outcome('r.recipe_json')} = 'good' THEN 'matched' ELSE 'error' END AS o "
    "FROM v_records r LEFT JOIN v_blogs b ON r.stem = b.stem)", "v_blogs", "v_records"))
def outcome_counts_pair(spark, sf_dir):
    """pairing counters over the left-joined records."""
    b = v_blogs(spark, sf_dir).select("stem", F.lit(True).alias("_has_blog"))
    j = v_records(spark, sf_dir).join(b, "stem", "left")
    o = F.when(F.col("_has_blog").isNull(), "missing").when(outcome() == GOOD, "matched").otherwise("error")
    return S.outcome_counts(j.withColumn("o", o), "o", ("matched", "missing", "error"))


@register("mean_time", with_views(
    "SELECT run, count(*) AS items, round(sum(seconds), 6) AS total_seconds, round(avg(seconds), 6) AS mean_seconds, "
    "round(avg(seconds) FILTER (WHERE outcome = 'success'), 6) AS mean_success_seconds, "
    f"{T.sql_human_time('sum(seconds)')} AS total_label FROM v_times GROUP BY run", "v_times"))
def mean_time(spark, sf_dir):
    """per run, items, total and mean time (all outcomes and successes only)."""
    t = v_times(spark, sf_dir)
    return (t.groupBy("run").agg(F.count(F.lit(1)).alias("items"), F.sum("seconds").alias("_tot"),
                                 F.round(F.avg("seconds"), 6).alias("mean_seconds"),
                                 F.round(F.avg(F.when(F.col("outcome") == "success", F.col("seconds"))), 6).alias("mean_success_seconds"))
             .select("run", "items", F.round("_tot", 6).alias("total_seconds"), "mean_seconds", "mean_success_seconds",
                     T.human_time("_tot").alias("total_label")))
