"""Queries: slices, listings, seeded splits, batches, windows and split checks
(D1-D3, D6-D8, G1-G4, H1-H3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions import text as T
from ladle.operators import split as SP
from ladle.operators.ids import group_running_sum
from ladle.operators.names import unique_names
from ladle.operators.route import GOOD, outcome, sql_outcome
from ladle.plans.catalog import register
from ladle.plans.views import SQL_VIEWS, table, v_blogs, v_recipe_json, v_recipes, v_records, v_times, with_views

SEED = 42
SKIP = 10          # D1: rows skipped before the slice
SLICE_LIMIT = 50   # D1: rows kept by the limited slice
LIMIT_INPUTS = 100  # D2: inputs taken before matching
SPLIT_RATIO = 0.8   # D6
TEST_SIZE = 0.05    # D7
BATCH = 48          # G3
PER_BATCH = 2       # D8


def _sql_hash(key: str) -> str:
    return T.sql_md5_number(f"'{SEED}:' || CAST({key} AS VARCHAR)")


@register("slice_rows", with_views(
    f"SELECT rid, name FROM (SELECT rid, name, row_number() OVER (ORDER BY CAST(rid AS BIGINT)) AS pos FROM v_recipes) WHERE pos > {SKIP}",
    "v_recipes"))
def slice_rows(spark, sf_dir):
    """Source records after skipping the first rows in id order (no limit)."""
    r = v_recipes(spark, sf_dir).withColumn("_o", F.col("rid").cast("bigint"))
    return SP.slice_rows(r, ["_o"], skip=SKIP).select("rid", "name")


@register("slice_limit", with_views(
    f"SELECT rid, name FROM v_recipes ORDER BY CAST(rid AS BIGINT) LIMIT {SLICE_LIMIT} OFFSET {SKIP}", "v_recipes"))
def slice_limit(spark, sf_dir):
    """A limited slice after the skipped rows (a resumed run's next inputs)."""
    r = v_recipes(spark, sf_dir).withColumn("_o", F.col("rid").cast("bigint"))
    return SP.slice_rows(r, ["_o"], skip=SKIP, limit=SLICE_LIMIT).select("rid", "name")


@register("limit_before_join", with_views(
    f"SELECT r.stem, r.rec_id, b.style FROM (SELECT * FROM v_records ORDER BY stem LIMIT {LIMIT_INPUTS}) r "
    "JOIN v_blogs b ON r.stem = b.stem", "v_blogs", "v_records"))
def limit_before_join(spark, sf_dir):
    """The first records in listing order, limited *before* matching blogs."""
    r = SP.limit_inputs(v_records(spark, sf_dir), ["stem"], LIMIT_INPUTS)
    return r.join(v_blogs(spark, sf_dir), "stem").select("stem", "rec_id", "style")


@register("sort_listing", with_views(
    "SELECT stem, row_number() OVER (ORDER BY stem) AS pos FROM v_blogs", "v_blogs"))
def sort_listing(spark, sf_dir):
    """D3: blog listing in code-point order as explicit positions."""
    return SP.sort_listing(v_blogs(spark, sf_dir).select("stem"), "stem")


_SQL_SPLIT = ("split80", f"""SELECT stem, CASE WHEN row_number() OVER (ORDER BY {_sql_hash('stem')}, stem)
  <= floor(CAST(count(*) OVER () AS DOUBLE) * CAST({SPLIT_RATIO} AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM v_blogs""")


def _split80(spark, sf_dir) -> DataFrame:
    return SP.split_exact(v_blogs(spark, sf_dir).select("stem"), "stem", SPLIT_RATIO, SEED)


@register("split_exact", with_views("SELECT stem, split FROM split80", "v_blogs", extra=[_SQL_SPLIT]))
def split_exact(spark, sf_dir):
    """Exact 80 / 20 seeded split of all blogs."""
    return _split80(spark, sf_dir)


_SQL_EXAMPLES = ("ex", f"SELECT r.stem FROM v_records r JOIN v_blogs b ON r.stem = b.stem WHERE {sql_outcome('r.recipe_json')} = 'good'")


@register("holdout_5pct", with_views(
    f"SELECT stem, CASE WHEN row_number() OVER (ORDER BY {_sql_hash('stem')}, stem) "
    f"<= ceil(CAST(count(*) OVER () AS DOUBLE) * CAST({TEST_SIZE} AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM ex",
    "v_blogs", "v_records", extra=[_SQL_EXAMPLES]))
def holdout_5pct(spark, sf_dir):
    """The fixed 5 % hold-out of the paired training examples."""
    ex = v_records(spark, sf_dir).where(outcome() == GOOD).join(v_blogs(spark, sf_dir).select("stem"), "stem").select("stem")
    return SP.holdout(ex, "stem", TEST_SIZE, SEED)


_SQL_BATCHES = ("batches", f"""SELECT doc_id, pos - 1 AS sample_id, CAST(floor((pos - 1) / {BATCH}) AS BIGINT) + 1 AS batch_num,
  (CAST(floor((pos - 1) / {BATCH}) AS BIGINT)) * {BATCH} + 1 AS batch_start,
  least((CAST(floor((pos - 1) / {BATCH}) AS BIGINT) + 1) * {BATCH}, n) AS batch_end
  FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS pos, count(*) OVER () AS n FROM v_recipe_json)""")


def _batches(spark, sf_dir) -> DataFrame:
    return SP.with_batch(v_recipe_json(spark, sf_dir).select("doc_id"), ["doc_id"], BATCH)


@register("batch_number", with_views("SELECT * FROM batches", "v_recipe_json", extra=[_SQL_BATCHES]))
def batch_number(spark, sf_dir):
    """Sample index, batch of 48 and batch bounds for every document."""
    return _batches(spark, sf_dir)


@register("first_n_per_batch", with_views(
    f"SELECT doc_id, sample_id, batch_num FROM (SELECT *, row_number() OVER (PARTITION BY batch_num ORDER BY sample_id) AS rn "
    f"FROM batches) WHERE rn <= {PER_BATCH}", "v_recipe_json", extra=[_SQL_BATCHES]))
def first_n_per_batch(spark, sf_dir):
    """The first two samples of every batch (the ones sent to the judge)."""
    return SP.first_n_per_batch(_batches(spark, sf_dir), PER_BATCH, BATCH).select("doc_id", "sample_id", "batch_num")


@register("row_position", with_views(
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM v_times", "v_times"))
def row_position(spark, sf_dir):
    """G1: [i/n] over all timings in (ts, event_id) order."""
    t = v_times(spark, sf_dir).select("event_id", "ts")
    return SP.with_position(t, ["ts", "event_id"]).select("event_id", "pos", "n")


@register("running_eta", with_views(
    "SELECT event_id, run, i, n, prev_mean, prev_mean * (n - i + 1) AS eta FROM ("
    "SELECT *, CASE WHEN i > 1 THEN CAST(before AS DOUBLE) / CAST(i - 1 AS DOUBLE) END AS prev_mean FROM ("
    "SELECT event_id, run, row_number() OVER w AS i, count(*) OVER (PARTITION BY run) AS n, "
    "sum(CAST(seconds AS DECIMAL(28, 9))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before "
    "FROM v_times WINDOW w AS (PARTITION BY run ORDER BY ts, event_id)))", "v_times"))
def running_eta(spark, sf_dir):
    """Per run, mean of earlier item times x items left (NULL on the first item).

    Times are summed as decimals of nine places, so the running mean does not depend
    on summation order (and equals any other engine's bit for bit)."""
    t = v_times(spark, sf_dir).select("event_id", "run", "ts", F.col("seconds").cast("decimal(28,9)").alias("exact"))
    r = group_running_sum(t, ["run"], ["ts", "event_id"], "exact", rank="i", before="_before", size="n")
    prev = F.when(F.col("i") > 1, F.col("_before").cast("double") / (F.col("i") - 1).cast("double"))
    return r.select("event_id", "run", "i", "n", prev.alias("prev_mean"),
                    (prev * (F.col("n") - F.col("i") + 1)).alias("eta"))


# some names already carry a number, so that generated names meet natural ones
_NUMBERED = "CASE WHEN {rid} % 40 = 0 THEN name || '_1' WHEN {rid} % 56 = 0 THEN name || '_2' ELSE name END"
# the twin takes names one by one: step k of every family of names, carrying the names taken before
_SQL_NAMES = f"""
WITH RECURSIVE named AS MATERIALIZED (SELECT rid, s, regexp_replace(s, '(_[0-9]+)+$', '') AS root FROM (
    SELECT rid, {T.sql_safe_name('n')} AS s FROM (SELECT rid, {_NUMBERED.format(rid='CAST(rid AS BIGINT)')} AS n FROM ({SQL_VIEWS["v_recipes"]})))),
  ranked AS MATERIALIZED (SELECT rid, s, root, row_number() OVER (PARTITION BY root ORDER BY CAST(rid AS BIGINT)) AS k FROM named),
  step AS (
    SELECT rid, root, k, s AS file_name, [s] AS taken FROM ranked WHERE k = 1
    UNION ALL
    SELECT rid, root, k, f, list_append(taken, f) FROM (
      SELECT r.rid, r.root, r.k, p.taken,
        list_filter(list_concat([r.s], list_transform(range(1, len(p.taken) + 2), lambda i: r.s || '_' || CAST(i AS VARCHAR))),
                    lambda x: NOT list_contains(p.taken, x))[1] AS f
      FROM step p JOIN ranked r ON r.root = p.root AND r.k = p.k + 1))
SELECT rid, file_name FROM step"""


@register("unique_name", _SQL_NAMES)
def unique_name(spark, sf_dir):
    """Unique file names for every source record, some of which carry a number already."""
    r = v_recipes(spark, sf_dir).select("rid", F.expr(_NUMBERED.format(rid="CAST(rid AS BIGINT)")).alias("name"))
    return unique_names(r.withColumn("_o", F.col("rid").cast("bigint")), "name", "_o").select("rid", "file_name")


@register("union_batches", with_views(
    "SELECT stem, split FROM split80 WHERE split = 'train' UNION ALL SELECT stem, split FROM split80 WHERE split = 'test'",
    "v_blogs", extra=[_SQL_SPLIT]))
def union_batches(spark, sf_dir):
    """H1: the two split sides appended back together."""
    s = _split80(spark, sf_dir)
    return SP.append_results(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"))


@register("split_invariants", with_views(
    "SELECT 'n_all' AS metric, count(*) AS value FROM v_blogs "
    "UNION ALL SELECT 'n_train', count(*) FILTER (WHERE split = 'train') FROM split80 "
    "UNION ALL SELECT 'n_test', count(*) FILTER (WHERE split = 'test') FROM split80 "
    "UNION ALL SELECT 'missing', count(*) FROM (SELECT stem FROM v_blogs EXCEPT ALL SELECT stem FROM split80) "
    "UNION ALL SELECT 'extra', count(*) FROM (SELECT stem FROM split80 EXCEPT ALL SELECT stem FROM v_blogs) "
    "UNION ALL SELECT 'overlap', count(*) FROM (SELECT stem FROM split80 WHERE split = 'train' INTERSECT SELECT stem FROM split80 WHERE split = 'test')",
    "v_blogs", extra=[_SQL_SPLIT]))
def split_invariants(spark, sf_dir):
    """H2: the split is a partition of the blogs (missing = extra = overlap = 0)."""
    s = _split80(spark, sf_dir)
    return SP.check_split(s.filter(F.col("split") == "train").select("stem"),
                          s.filter(F.col("split") == "test").select("stem"), v_blogs(spark, sf_dir).select("stem"))


@register("split_leak", f"""
WITH s AS (SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY {_sql_hash('doc_id')}, doc_id)
  <= ceil(CAST(count(*) OVER () AS DOUBLE) * CAST({TEST_SIZE} AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM documents)
SELECT doc_id FROM s t WHERE split = 'test' AND md5(text) IN (SELECT md5(text) FROM s WHERE split = 'train')""")
def split_leak(spark, sf_dir):
    """H3: held-out documents whose exact text is also in the training side."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text_md5"))  # hashed before ranking: no text is shuffled
    d = SP.holdout(d, "doc_id", TEST_SIZE, SEED)
    return SP.leaked(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test"), "text_md5").select("doc_id")
