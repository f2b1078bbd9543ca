"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: the Parquet writer looks at its size after 100 rows only, and a reader takes up all rows of a row group at once
_LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size": str(16 << 20)}


def scratch_table(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage with data that every executor can read, so a lost executor costs a
    re-read and not the job.  The folder goes when the process ends.  ``large_rows``: rows are MBs each, and
    tasks that write and read them hold a few at a time.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**_LARGE_ROWS if large_rows else {}).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only if ``df`` (a written table) has at most ``max_rows`` rows.
    Beyond that the join stays a shuffle join, which adaptive execution may split."""
    return F.broadcast(df) if df.count() <= max_rows else df


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


def unit_hash(*parts) -> Column:
    """Uniform double in [0, 1) from the first 52 bits of an MD5 over ':'-joined parts."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns only, so that extra columns cannot clash with internal names."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
