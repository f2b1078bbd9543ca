"""The pipeline runs end to end on the smallest tables and each stage's decisions take effect."""

import corpus_pipeline as P


def test_stages_in_order(spark, sf_dir, docs001, tmp_path):
    assert [n for n, _ in P.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "packing"]
    docs, sizes = docs001, []
    for i, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(P.STAGES) - 1:
            assert out.columns == docs001.columns
            out.write.parquet(str(tmp_path / str(i)))
            docs = spark.read.parquet(str(tmp_path / str(i)))
            sizes.append(docs.count())
    assert out.columns[:2] == ["doc_id", "start"] and out.count() > 0
    assert docs001.count() >= sizes[0] >= sizes[1] > sizes[2] > 0


def test_run_is_the_registered_query(spark, sf_dir):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is P.run
    assert "pipeline" not in E.oracle_sql()
    assert P.run(spark, sf_dir).count() > 0
