"""Longest-processing-time sharding: equal texts stay together, shards get near-equal bytes.

Every distinct text is a group.  Groups, largest first, go to the least-loaded
shard through a heap.  The heap runs over a number of items that does not grow
with the data: a group of at least 1/ITEMS of all bytes is an item of its own (there
are at most ITEMS of those), and smaller groups are gathered by hash into ITEMS
bundles.  A bundle is about 1/ITEMS of the bytes, so shards end within about one
bundle of each other.  Everything per document or per group stays in Spark.

Defined cases: a null text counts as empty (size 1, the same group as an empty
text); null ids are kept; repeated rows are separate rows of one group; ties in size
go by item id, ties in load to the smaller shard; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import scratch_table

ITEMS = 8192
SLOT_BLOCKS = 1024


def lpt(sizes: dict[str, int], shards: int) -> dict[str, int]:
    """Item -> shard: items by falling size (ties: item id), each to the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    items: int = ITEMS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot (gapless from 0 in the shard)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("grp"),
        F.monotonically_increasing_id().alias("row"))
    rows = scratch_table(rows, "shard-rows")
    groups = rows.groupBy("grp", "text_crc32", "size").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    group_id = F.concat_ws("/", F.col("grp").cast("string"), F.col("text_crc32").cast("string"), F.col("size").cast("string"))
    bundle = F.concat(F.lit("b"), F.pmod(F.xxhash64("grp", "text_crc32", "size"), F.lit(items)).cast("string"))
    heavy = F.col("bytes") * items >= total
    # at most ITEMS heavy groups and ITEMS bundles, whatever the table's size
    loads = groups.groupBy(F.when(heavy, group_id).otherwise(bundle).alias("item")).agg(F.sum("bytes").alias("bytes"))
    placed = lpt({r["item"]: r["bytes"] for r in loads.collect()}, shards)
    own = [(k, s) for k, s in placed.items() if not k.startswith("b")]
    rest = [(k, s) for k, s in placed.items() if k.startswith("b")]
    schema = "item string, shard int"
    own_df = spark.createDataFrame(own, schema).select(F.col("item").alias("own_item"), F.col("shard").alias("own_shard"))
    rest_df = spark.createDataFrame(rest, schema).select(F.col("item").alias("rest_item"), F.col("shard").alias("rest_shard"))
    out = (rows.withColumn("own_item", group_id).withColumn("rest_item", bundle)
               .join(F.broadcast(own_df), "own_item", "left").join(F.broadcast(rest_df), "rest_item", "left")
               .withColumn("shard", F.coalesce("own_shard", "rest_shard")))
    # slots: number rows inside blocks dealt by row hash, then add the block's prefix (SLOT_BLOCKS rows a shard)
    out = out.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(SLOT_BLOCKS)).cast("int"))
    counts = out.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    prefix = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    inside = Window.partitionBy("shard", "block").orderBy("row")
    return (out.withColumn("nth", F.row_number().over(inside) - 1)
               .join(F.broadcast(prefix), ["shard", "block"])
               .select("doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("nth")).cast("bigint").alias("slot")))
