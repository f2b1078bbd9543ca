"""The registered queries of this subpackage (key -> (builder, DuckDB twin or None))."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import oracle
from ladle.llm.common import table

Builder = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.license_scan import scan
    return scan(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.near_dedup import deduplicate
    return deduplicate(table(spark, sf_dir, "documents"))


def op4_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.quality_rules import judge
    return judge(table(spark, sf_dir, "documents"))


def op7_vptree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.vptree import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op8_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.sharding import shard_documents
    out = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.toxicity import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.language import identify
    return identify(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.conversation_repair import audit, damage
    return audit(damage(table(spark, sf_dir, "conversations")))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.url_filter import judge
    return judge(table(spark, sf_dir, "pages"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladle.llm.token_alignment import align
    return align(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple[Builder, str | None]] = {
    "op1_license_scan": (op1_license_scan, oracle.license_scan()),
    "op2_quality_classifier": (op2_quality_classifier, None),
    "op3_near_duplicates": (op3_near_duplicates, oracle.near_duplicates()),
    "op4_bm25_packing": (op4_bm25_packing, None),
    "op5_poisson_mix": (op5_poisson_mix, oracle.poisson_mix()),
    "op6_quality_rules": (op6_quality_rules, oracle.quality_rules()),
    "op7_vptree_neighbours": (op7_vptree_neighbours, oracle.nearest()),
    "op8_lpt_sharding": (op8_lpt_sharding, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_language_id": (op10_language_id, None),
    "op11_conversation_repair": (op11_conversation_repair, oracle.conversation_repair()),
    "op12_url_filter": (op12_url_filter, oracle.url_filter()),
    "op13_token_alignment": (op13_token_alignment, None),
}
