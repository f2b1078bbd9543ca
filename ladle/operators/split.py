"""Slices, limits, sorted listings, seeded splits, batches and split checks
(D1-D4, D6-D8, G1, G3, H1-H3).

Randomness is always ``md5(seed:key)``: the same in every engine, independent
of partitioning, and stable under re-execution (``rand()`` and
``randomSplit`` are neither exact nor partition-independent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.text import md5_number
from ladle.operators.ids import global_rank, hash_rank


def seeded_hash(key: Column, seed) -> Column:
    return md5_number(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def with_position(df: DataFrame, order_cols, pos: str = "pos", total: str = "n") -> DataFrame:
    """G1: position ``[i/n]`` over an order that ends in a unique key."""
    return global_rank(df, order_cols, name=pos, total=total)


def slice_rows(df: DataFrame, order_cols, skip: int = 0, limit: int | None = None) -> DataFrame:
    """Skip ``skip`` rows in order, then keep ``limit`` (0 / None: no limit).

    A filter on the global position: no task ever holds ``skip + limit`` rows.
    """
    if not skip and not limit:
        return df
    pos = F.col("_pos")
    kept = (pos > skip) & (pos <= skip + limit) if limit else pos > skip
    return global_rank(df, order_cols, name="_pos").filter(kept).drop("_pos")


def limit_inputs(df: DataFrame, order_cols, n: int | None) -> DataFrame:
    """The first ``n`` inputs in listing order, taken *before* any matching."""
    return slice_rows(df, order_cols, 0, n)


def sort_listing(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """D3: listing order by code point, as an explicit position column."""
    return global_rank(df, [key], name=pos)


def split_exact(df: DataFrame, key: str, ratio: float, seed, label: str = "split") -> DataFrame:
    """Exactly ``int(n * ratio)`` rows are ``train`` (first in seeded order), the rest ``test``.

    ``ratio`` 0 or None means no split: every row is ``train``.
    """
    if not ratio:
        return df.withColumn(label, F.lit("train"))
    ranked = hash_rank(df.withColumn("_h", seeded_hash(F.col(key), seed)), "_h", key, name="_r", total="_n")
    cut = F.floor(F.col("_n").cast("double") * F.lit(float(ratio)))
    return ranked.withColumn(label, F.when(F.col("_r") <= cut, "train").otherwise("test")).drop("_h", "_r", "_n")


def holdout(df: DataFrame, key: str, test_size: float = 0.05, seed=42, label: str = "split") -> DataFrame:
    """``ceil(n * test_size)`` rows are ``test`` (first in seeded order), the rest ``train``.

    Deterministic: training and evaluation re-derive the identical split.
    """
    ranked = hash_rank(df.withColumn("_h", seeded_hash(F.col(key), seed)), "_h", key, name="_r", total="_n")
    n_test = F.ceil(F.col("_n").cast("double") * F.lit(float(test_size)))
    return ranked.withColumn(label, F.when(F.col("_r") <= n_test, "test").otherwise("train")).drop("_h", "_r", "_n")


def with_batch(df: DataFrame, order_cols, size: int = 48, idx: str = "sample_id", batch: str = "batch_num") -> DataFrame:
    """0-based sample index, batch number ``idx // size + 1``, and batch bounds."""
    ranked = global_rank(df, order_cols, name="_pos", total="_n")
    return (ranked.withColumn(idx, F.col("_pos") - 1)
                  .withColumn(batch, F.floor(F.col(idx) / size).cast("bigint") + 1)
                  .withColumn("batch_start", (F.col(batch) - 1) * size + 1)
                  .withColumn("batch_end", F.least(F.col(batch) * size, F.col("_n")))
                  .drop("_pos", "_n"))


def first_n_per_batch(df: DataFrame, n: int = 2, size: int = 48, idx: str = "sample_id", batch: str = "batch_num") -> DataFrame:
    """The first ``n`` samples of each batch made by ``with_batch``: a filter, since a sample's place
    in its batch follows from its index."""
    return df.filter(F.col(idx) - (F.col(batch) - 1) * size < n)


def append_results(a: DataFrame, b: DataFrame) -> DataFrame:
    """H1: append result sets by column name (repeated rows kept)."""
    return a.unionByName(b)


def check_split(train: DataFrame, test: DataFrame, everything: DataFrame) -> DataFrame:
    """H2: (metric, value) rows; a correct split has ``missing = extra = overlap = 0``.

    One shuffle: every side is tagged, and each key's rows are counted by side.
    """
    key = F.struct(*[F.col(c) for c in everything.columns])
    tagged = [df.select(*everything.columns).select(key.alias("key"), F.lit(side).alias("side"))
              for side, df in enumerate((everything, train, test))]
    per_key = tagged[0].union(tagged[1]).union(tagged[2]).groupBy("key").agg(
        *[F.count_if(F.col("side") == side).alias(c) for side, c in enumerate(("n_all", "n_train", "n_test"))])
    split = F.col("n_train") + F.col("n_test")
    total = per_key.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_all", "n_train", "n_test")],
        F.coalesce(F.sum(F.greatest(F.col("n_all") - split, F.lit(0))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.greatest(split - F.col("n_all"), F.lit(0))), F.lit(0)).alias("extra"),
        F.count_if((F.col("n_train") > 0) & (F.col("n_test") > 0)).alias("overlap"))
    return total.unpivot([], total.columns, "metric", "value")


def leaked(train: DataFrame, test: DataFrame, text_hash: str) -> DataFrame:
    """H3: held-out rows whose text was also trained on.  Takes hashes, so that no text is shuffled."""
    return test.join(train.select(text_hash).distinct(), text_hash, "left_semi")
