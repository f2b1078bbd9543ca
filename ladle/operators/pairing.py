"""Joins between records, documents and results.

Keys are unique on the record side (``stem`` / ``sample_id``), so every join is
1:1 or 1:0; Spark chooses broadcast or sort-merge at run time (AQE).  The style
catalogue is the one side broadcast on purpose: its size is fixed by design.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.plans.views import STYLE_PROMPTS, style_bounds


def pair(records: DataFrame, blogs: DataFrame, key: str = "stem") -> DataFrame:
    """Records with their blog text (inner, 1:1 on ``key``)."""
    return records.join(blogs, key, "inner")


def unpaired(records: DataFrame, blogs: DataFrame, key: str = "stem") -> DataFrame:
    """Records that find no blog."""
    return records.join(blogs.select(key), key, "left_anti")


def style_catalogue(spark: SparkSession) -> DataFrame:
    """M2: (style, weight, prompt, lo, hi) rows of the fixed catalogue."""
    return spark.createDataFrame([(n, w, STYLE_PROMPTS[n], lo, hi) for n, w, lo, hi in style_bounds()],
                                 "style string, weight int, prompt string, lo int, hi int")


def with_style(df: DataFrame, spark: SparkSession, style: str = "style") -> DataFrame:
    """Style row for each document (catalogue of fixed size, broadcast)."""
    return df.join(F.broadcast(style_catalogue(spark).withColumnRenamed("style", style)), style, "left")


def weighted_pick(df: DataFrame, spark: SparkSession, bucket: str) -> DataFrame:
    """Range join of a bucket number onto the cumulative weights (broadcast
    nested-loop join against the fixed catalogue)."""
    cat = F.broadcast(style_catalogue(spark))
    return df.join(cat, (F.col(bucket) >= cat["lo"]) & (F.col(bucket) < cat["hi"]), "inner").drop("lo", "hi", "prompt")


def pending(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """E5: inputs that have no output yet (resume)."""
    return inputs.join(outputs.select(key), key, "left_anti")


def attach_scores(samples: DataFrame, scores: DataFrame, key: str = "sample_id") -> DataFrame:
    """Every sample, with its score columns where one was computed (NULL otherwise)."""
    return samples.join(scores, key, "left")
