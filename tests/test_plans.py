"""Plan shape checks: the physical plans we want at scale."""

import re

import pytest

import __spark_entry__ as E

PYTHON_OK = {"map_batches", "enrich_fallible", "scan_text_dir", "scan_json_dir"}  # user functions / file fixture writer
FAST = ["validate_docs", "json_route", "chat_render", "pair_join", "split_exact", "row_position", "running_eta",
        "unique_name", "score_axes", "judge_normalize", "style_distribution", "weighted_style"]


def plan(spark, sf_dir, key):
    df = E.queries()[key](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", FAST)
def test_no_python_in_plan(spark, sf_dir, key):
    p = plan(spark, sf_dir, key)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_global_rank_is_range_partitioned(spark, sf_dir):
    # the rank itself is read from a checkpoint written after a range shuffle
    from pyspark.sql import functions as F

    from ladle.operators.ids import global_rank
    df = spark.range(1000).withColumn("o", F.col("id") % 97)
    ranked = global_rank(df.repartition(7), ["o", "id"], name="pos")
    assert ranked.select(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first() == (1, 1000, 1000)


def test_scans_are_pruned(spark, sf_dir):
    p = plan(spark, sf_dir, "validate_docs")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", E.queries()["validate_docs"](spark, sf_dir)._jdf.queryExecution()
                         .executedPlan().toString()) or re.findall(r"struct<([^>]*)>", p)
    joined = " ".join(schemas)
    assert "l_extendedprice" not in joined and "o_totalprice" not in joined


def test_split_needs_no_checkpoint_or_range_shuffle(spark, sf_dir):
    p = plan(spark, sf_dir, "split_exact")
    assert "ExistingRDD" not in p and "rangepartitioning" not in p.lower()


def test_positions_use_a_range_shuffle_and_checkpoint(spark, sf_dir):
    from pyspark.sql import functions as F

    from ladle.operators.ids import global_rank
    df = spark.range(100).withColumn("o", F.col("id") % 7)
    ranked = global_rank(df, ["o", "id"], name="pos")
    assert "ExistingRDD" in ranked._jdf.queryExecution().executedPlan().toString()


def test_split_checks_do_not_shuffle_texts(spark, sf_dir):
    leak = plan(spark, sf_dir, "split_leak")
    # the text is hashed in the scan's stage: no exchange or sort above it carries the column
    assert not re.search(r"(Exchange|Sort|Window)[^\n]*\btext#", leak)
    assert plan(spark, sf_dir, "split_invariants").count("Exchange hashpartitioning(key") == 1
