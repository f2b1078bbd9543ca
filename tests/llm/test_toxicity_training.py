"""op9 learns from every labelled row that is not held out, in one shard or in several."""

import numpy as np

from ladle.llm import toxicity as TX


def test_no_labelled_row_is_left_out(spark, monkeypatch):
    n = 5600  # over 4,000 usable rows of one class, and long texts
    docs = spark.range(n).selectExpr("id AS doc_id", "CASE WHEN id % 1400 = 0 THEN repeat('long ', 25000) ELSE concat('word', id % 7) END AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 100 = 0 AS INT) AS toxic")
    usable = labels.where(TX.fold("doc_id", TX.FOLD[0]) != TX.FOLD[1])
    taken = []

    def spy(*args, **kwargs):
        sample, counts = real(*args, **kwargs)
        taken.append(sample)
        return sample, counts
    real = TX.labelled_sample
    monkeypatch.setattr(TX, "labelled_sample", spy)
    monkeypatch.setattr(TX, "VISITS", 1)
    monkeypatch.setattr(TX, "ROUNDS", (1, 1))
    assert TX.train(docs, labels) is not None
    ids = usable.join(taken[0], "doc_id", "left_anti")
    assert ids.count() == 0 and taken[0].count() == usable.count()


def test_shards_give_one_model_whatever_the_partitioning(spark, monkeypatch):
    monkeypatch.setattr(TX, "SHARD_ROWS", 150)
    docs = spark.createDataFrame([(i, f"word{i % 11} plain " + ("bad thing" if i % 8 == 0 else "good thing")) for i in range(700)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(700)], "doc_id bigint, toxic int")
    a = TX.train(docs.repartition(7), labels)
    b = TX.train(docs.repartition(2), labels.repartition(3))
    assert np.array_equal(a.table, b.table) and a.knots == b.knots and np.array_equal(a.out, b.out)
    rows = TX.score(docs, a, ["doc_id"]).collect()
    assert [r["doc_id"] % 8 == 0 for r in rows] == [r["score"] >= TX.CUT for r in rows]


def test_shards_of_one_class_only_train_nothing(spark, monkeypatch):
    monkeypatch.setattr(TX, "SHARD_ROWS", 50)
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('word', id) AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id >= 200 AS INT) AS toxic")  # the toxic ones have no text
    assert TX.train(docs, labels) is None
