"""Global positions, skew-safe group ranks and running sums (G1-G4 building blocks).

An un-partitioned window (``row_number() over (order by ...)``) runs in one
task.  ``global_rank`` instead range-partitions on the order, writes the result
once with a reliable ``checkpoint()`` (to the shared ``spark.checkpoint.dir``) so
partition contents and order are fixed even if executors are lost, and numbers
rows as ``offset of partition + index in partition``.  The offset table has one
row per partition, so broadcasting it is bounded by the partition count, not by
the data.

Ranks and running sums *within* groups reuse those global positions: rows are
ordered by (group, order), so a group is a contiguous run of positions.  A
window inside each range partition finds local group starts; a group that
continues from earlier partitions is resolved from a one-row-per-partition
edge table.  A hot group is therefore split across every partition it spans
instead of going to one task, and nothing the size of the data is joined back.

``hash_rank`` is the cheaper path when the order is a uniform hash (seeded
splits): one shuffle by hash bucket, no sampling, no checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.session import checkpoint_dir

_IDX_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index
_IDX_MASK = (1 << _IDX_BITS) - 1


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """Range partitions: ``partitions`` if given, else ``spark.sql.shuffle.partitions``,
    which a cluster sizes to its data (about one partition per 128-256 MB of
    the ranked columns).  Asking the input for its partition count instead
    could run upstream shuffle stages early under AQE."""
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_rank(df: DataFrame, order_cols, name: str = "pos", total: str | None = None,
                partitions: int | None = None, keep_internal: bool = False) -> DataFrame:
    """Add a 1-based position ``name`` over ``order_cols`` (which must end in a unique key).

    ``total`` (optional) names a column holding the row count.  With
    ``keep_internal`` the partition id ``_pid`` is kept for later group helpers.
    """
    checkpoint_dir(df.sparkSession)
    order = _cols(order_cols)
    ranged = df.repartitionByRange(_partitions(df, partitions), *order).sortWithinPartitions(*order)
    ranged = ranged.checkpoint(eager=True)
    tagged = ranged.withColumn("_gid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright("_gid", _IDX_BITS)).withColumn("_idx", F.col("_gid").bitwiseAND(F.lit(_IDX_MASK)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-task window here is bounded by the partition count
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_total"))
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_idx") + 1)
    if total:
        out = out.withColumn(total, F.col("_total"))
    drop = ["_gid", "_idx", "_off", "_total"] + ([] if keep_internal else ["_pid"])
    return out.drop(*drop)


def _with_group_start(ranked: DataFrame, group_cols: list[str], pos: str, value: str | None = None, size: str | None = None) -> DataFrame:
    """Add ``_start`` (global position of the row's group's first row) and, with
    ``value``, ``_cum0`` (running total of ``_cum`` just before that row); with ``size``,
    the number of rows of the row's group.

    Rows are range-partitioned and sorted by (group, order), so inside a
    partition a window finds each group's local start.  Only a group that
    continues from earlier partitions needs more: it is the first group of
    its partition and the last group of each earlier partition it touches.
    One row per partition (first / last group, last group's local start) is
    enough to resolve it, and that table is broadcast: its size is the
    partition count, however the groups are distributed.
    """
    g = F.struct(*[F.col(c) for c in group_cols])
    w = Window.partitionBy("_pid").orderBy(pos)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    is_start = F.coalesce(~F.lag(g).over(w).eqNullSafe(g), F.lit(True))
    d = ranked.withColumn("_gs", is_start)
    d = d.withColumn("_lstart", F.last(F.when(F.col("_gs"), F.col(pos)), ignorenulls=True).over(run))
    if value:
        d = d.withColumn("_lcum0", F.last(F.when(F.col("_gs"), F.col("_cum") - F.col(value)), ignorenulls=True).over(run))
    d = d.drop("_gs").withColumn("_g", g)
    if size:
        d = d.withColumn("_ln", F.count(F.lit(1)).over(Window.partitionBy("_pid", "_g")))
    aggs = [F.min_by("_g", pos).alias("_first_g"), F.min(pos).alias("_first_pos"),
            F.max_by("_g", pos).alias("_last_g"), F.max_by("_lstart", pos).alias("_last_start")]
    if value:
        aggs.append(F.max_by("_lcum0", pos).alias("_last_cum0"))
    if size:
        aggs += [F.min_by("_ln", pos).alias("_first_n"), F.max_by("_ln", pos).alias("_last_n")]
    edges = d.groupBy("_pid").agg(*aggs)
    # earliest start of every group that ends a partition (bounded: one row per partition)
    sagg = [F.min("_last_start").alias("_gstart")]
    if value:
        sagg.append(F.min_by("_last_cum0", "_last_start").alias("_gcum0"))
    starts = edges.groupBy(F.col("_last_g").alias("_sg")).agg(*sagg)
    carry = edges.join(starts, edges["_first_g"].eqNullSafe(starts["_sg"]), "left")
    carried = F.col("_gstart").isNotNull() & (F.col("_gstart") < F.col("_first_pos"))
    cols = [F.col("_pid"), F.col("_first_g"), F.when(carried, F.col("_gstart")).alias("_cstart")]
    if value:
        cols.append(F.when(carried, F.col("_gcum0")).alias("_ccum0"))
    carry = carry.select(*cols)
    out = d.join(F.broadcast(carry), "_pid")
    continues = F.col("_g").eqNullSafe(F.col("_first_g")) & F.col("_cstart").isNotNull()
    out = out.withColumn("_start", F.when(continues, F.col("_cstart")).otherwise(F.col("_lstart")))
    if value:
        out = out.withColumn("_cum0", F.when(continues, F.col("_ccum0")).otherwise(F.col("_lcum0")))
    if size:
        # only a partition's first and last group can go on elsewhere: two rows a partition
        ends = edges.select(F.col("_first_g").alias("_eg"), F.col("_first_n").alias("_en")).union(
            edges.filter(~F.col("_first_g").eqNullSafe(F.col("_last_g"))).select("_last_g", "_last_n"))
        sizes = ends.groupBy("_eg").agg(F.sum("_en").alias("_en"))
        out = out.join(F.broadcast(sizes), F.col("_g").eqNullSafe(F.col("_eg")), "left")
        out = out.withColumn(size, F.coalesce("_en", "_ln")).drop("_eg", "_en", "_ln", "_first_n", "_last_n")
    return out.drop("_g", "_first_g", "_cstart", "_lstart", *(["_ccum0", "_lcum0"] if value else []))


def group_rank(df: DataFrame, group_cols: list[str], order_cols, name: str = "rank",
               partitions: int | None = None) -> DataFrame:
    """1-based rank within each group by ``order_cols`` (ties must be broken by a unique key).

    Equal to ``row_number() over (partition by group order by order)`` but a
    group holding a third of all rows is still spread over many tasks, and no
    table the size of the data is joined back.
    """
    ranked = global_rank(df, list(group_cols) + list(order_cols), name="_gpos", partitions=partitions, keep_internal=True)
    out = _with_group_start(ranked, list(group_cols), "_gpos")
    return out.withColumn(name, F.col("_gpos") - F.col("_start") + 1).drop("_pid", "_gpos", "_start")


def group_running_sum(df: DataFrame, group_cols: list[str], order_cols, value: str,
                      rank: str = "rank", before: str = "sum_before", partitions: int | None = None,
                      size: str | None = None) -> DataFrame:
    """Rank within group plus the sum of ``value`` over the *earlier* rows of the group
    (and, with ``size``, the group's row count).

    Prefix sums are global (per-partition totals, prefix-summed over the small
    partition table, then a window inside each range partition); the group's
    own prefix is subtracted using the same partition-edge table as
    ``group_rank``.
    """
    ranked = global_rank(df, list(group_cols) + list(order_cols), name="_gpos", partitions=partitions, keep_internal=True)
    # the value keeps its type: integral inputs give exact prefix sums
    d = ranked.withColumn("_v", F.coalesce(F.col(value), F.lit(0)))
    w_in = Window.partitionBy("_pid").orderBy("_gpos").rowsBetween(Window.unboundedPreceding, 0)
    part_tot = d.groupBy("_pid").agg(F.sum("_v").alias("_ptot"))
    w_p = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    part_off = part_tot.select("_pid", F.coalesce(F.sum("_ptot").over(w_p), F.lit(0)).alias("_poff"))
    cum = (d.withColumn("_local", F.sum("_v").over(w_in)).join(F.broadcast(part_off), "_pid")
            .withColumn("_cum", F.col("_poff") + F.col("_local")))
    out = _with_group_start(cum, list(group_cols), "_gpos", value="_v", size=size)
    out = (out.withColumn(rank, F.col("_gpos") - F.col("_start") + 1)
              .withColumn(before, F.col("_cum") - F.col("_v") - F.col("_cum0")))
    return out.drop("_pid", "_gpos", "_start", "_v", "_local", "_poff", "_cum", "_cum0")


HASH_BUCKET_BITS = 16  # 65,536 buckets: the prefix table is bounded by this, not by the data


def hash_rank(df: DataFrame, hash_col: str, key: str, name: str = "pos", total: str | None = None) -> DataFrame:
    """Position by (``hash_col``, ``key``) where ``hash_col`` is a uniform 32-bit hash.

    No sampling and no checkpoint: the top bits of the hash are a bucket, so
    one shuffle by bucket orders every row, each bucket holds about
    1/65,536 of the rows, and a bucket-count prefix (at most 65,536 rows,
    broadcast) turns the rank inside a bucket into a global position.  All
    inputs are deterministic, so a lost task recomputes the same ranks.
    """
    shift = 32 - HASH_BUCKET_BITS
    d = df.withColumn("_hb", F.shiftright(F.col(hash_col), shift))
    hist = d.groupBy("_hb").agg(F.count(F.lit(1)).alias("_hn"))
    w_all = Window.orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    prefix = hist.select("_hb", F.coalesce(F.sum("_hn").over(w_all), F.lit(0)).alias("_hbefore"),
                         F.sum("_hn").over(Window.partitionBy()).alias("_htotal"))
    w_in = Window.partitionBy("_hb").orderBy(hash_col, key)
    out = (d.withColumn("_hr", F.row_number().over(w_in))
             .join(F.broadcast(prefix), "_hb")
             .withColumn(name, F.col("_hbefore") + F.col("_hr")))
    if total:
        out = out.withColumn(total, F.col("_htotal"))
    return out.drop("_hb", "_hn", "_hr", "_hbefore", "_htotal")
