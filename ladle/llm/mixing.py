"""Poisson replication to target source weights.

Each source gets a target repetition rate: its share of the target mix times the
total, over its row count.  A document's number of copies is drawn by inverting a
Poisson distribution with that mean at a hash of (seed, document), so every run and
every partitioning gives the same copies.  Means above ``CHUNK`` are the sum of
independent draws with equal smaller means, which is exact for Poisson variables.
Copies are then dealt to partitions by a hash and sorted by it: a global shuffle.

Defined cases: a null source is a source of its own; a null id is replaced by the
text's MD5; repeated rows draw the same count; a source without a weight gets no
copies; empty tables give no rows; extra columns are carried along and the added
columns replace any of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import bounded_broadcast, scratch_table, unit_hash

CHUNK = 32.0
#: sources that may be broadcast (under 1 KB each)
MAX_BROADCAST_SOURCES = 20_000


def _cdf(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... as far as a double can tell from 1 (mean at most CHUNK)."""
    last = F.ceil(mean + 10.0 * F.sqrt(mean) + 20.0).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("cdf"))

    def step(acc, k):
        p = acc["p"] * mean / k
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.array_append(acc["cdf"], c).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["cdf"])


def target_rates(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5, source: str = "source",
                 total: int | None = None) -> DataFrame:
    """(source, rate): copies wanted per document of each source.

    ``weights`` (source, weight) names the target mix; without it a source's
    weight is its row count to the given power.  ``total`` is the number of rows
    wanted (default: as many as there are).
    """
    counts = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.sqrt("n") if power == 0.5 else F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double"))
        weighed = counts.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source").fillna({"weight": 0.0})
    weighed = scratch_table(weighed, "mix-weights")
    sums = weighed.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights")).first()
    rows, all_weights = (total or sums["rows"] or 0), (sums["weights"] or 1.0)
    return weighed.select("source", "n", (F.col("weight") / F.lit(float(all_weights)) * F.lit(float(rows)) / F.col("n")).alias("rate"))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 42, source: str = "source", id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Every document as many times as its draw says, with ``copy`` (from 1), ``rate`` and ``shuffle_key``."""
    draws = F.greatest(F.lit(1), F.ceil(F.col("_rate") / CHUNK).cast("int"))
    table = (rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"))
                  .withColumn("_draws", draws).withColumn("_cdf", _cdf(F.col("_rate") / F.col("_draws"))))
    table = bounded_broadcast(scratch_table(table, "mix-rates"), MAX_BROADCAST_SOURCES)
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))
    added = ["_source", "_rate", "_draws", "_cdf", "_key", "_n", "copy", "rate", "shuffle_key"]
    plain = docs.drop(*[c for c in docs.columns if c in added])
    joined = plain.join(table, F.col(f"`{source}`").eqNullSafe(F.col("_source"))).withColumn("_key", key)
    # the smallest k with P(X <= k) above the hash, summed over the draws
    count = F.aggregate(F.sequence(F.lit(1), F.col("_draws")), F.lit(0), lambda acc, j: acc + F.size(
        F.filter(F.col("_cdf"), lambda c: c <= unit_hash(F.lit(seed), F.col("_key"), j))))
    copies = joined.withColumn("_n", count).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"shuffle-{seed}"), "_key", F.col("copy").cast("string")).cast("binary")), 1, 15), 16, 10)
    return (copies.withColumn("shuffle_key", order.cast("bigint")).withColumn("rate", F.col("_rate"))
                  .drop("_source", "_rate", "_draws", "_cdf", "_key", "_n")
                  .repartition("shuffle_key").sortWithinPartitions("shuffle_key"))


def mix(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5, seed: int = 42, source: str = "source",
        id_col: str = "doc_id", text_col: str = "text", total: int | None = None) -> DataFrame:
    return replicate(docs, target_rates(docs, weights, power, source, total), seed, source, id_col, text_col)
