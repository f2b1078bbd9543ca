"""The corpus pipeline: toxicity, language ID, near-duplicates, source mixing, packing.

``run(spark, sf_dir)`` applies STAGES to the documents table.  Each stage's result is
written as Parquet in the shared checkpoint folder and reread as the next one's input.
No DuckDB SQL expresses trained models, near-duplicate groups or packing, so ORACLE_SQL
is None and tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ladle.llm.common import scratch_table, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents scored as toxic go."""
    from ladle.llm.toxicity import drop_toxic
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents without a sure language go."""
    from ladle.llm.language import keep_identified
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each near-duplicate group stays."""
    from ladle.llm.near_dedup import drop_near_duplicates
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: sources replicated or thinned to the target mix."""
    from ladle.llm.mixing import mix
    return mix(docs).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents packed into sequences with their lexical neighbours."""
    from ladle.llm.packing import pack_documents
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("language", language), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
