"""Connected components of an edge table, in Spark, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import scratch_table


#: edges a task writes, by the count of the round before
EDGES_A_TASK = 100_000
#: nodes whose smallest neighbour may be broadcast (two numbers each)
MAX_BROADCAST_NODES = 1_000_000


def _least(edges: DataFrame, small: bool) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    return F.broadcast(least) if small else least


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Every node links its larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    joined = both.join(_least(both, small), F.col("a") == F.col("u"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = _least(edges, small)
    rest = edges.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("u", "m"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): label is the smallest node of the component; only nodes with an edge appear.

    ``edges`` has bigint columns a and b; loops, repeated edges and both directions are allowed.
    Each round is a written table, its edges point from the larger to the smaller node.  It ends
    when a round changes nothing, which is when every component is a star around its smallest node.
    """
    now = scratch_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen["n"], seen["h"]) == mark or not seen["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
        mark = (seen["n"], seen["h"])
        small = 2 * seen["n"] <= MAX_BROADCAST_NODES
        tasks = 1 + 2 * seen["n"] // EDGES_A_TASK  # a round does not add edges, so a few full files instead of many empty ones
        large = scratch_table(_large_star(now, small).coalesce(tasks), name)
        now = scratch_table(_small_star(large, small).where("a <> b").distinct().coalesce(tasks), name)
