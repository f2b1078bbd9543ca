"""Trained operators: held-out accuracy, and the fast paths against plain formulas."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ladle.llm import language as LG
from ladle.llm import quality as QL
from ladle.llm import toxicity as TX

SF01 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")


def held_out(doc_id, mod, rest):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod == rest


def accuracy(rows, truth):
    known = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    hit = Counter(known)
    return (hit[(1, 1)] / max(1, hit[(1, 1)] + hit[(0, 1)]), hit[(0, 0)] / max(1, hit[(0, 0)] + hit[(1, 0)]))


def test_quality_on_held_out_rows(big):
    docs, labels = big
    rows = QL.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == held_out(r["doc_id"], 3, 1) and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    good, bad = accuracy(rows, {r["doc_id"]: r["quality"] for r in labels.collect()})
    assert good > 0.95 and bad > 0.9


def test_toxicity_on_held_out_rows(big):
    docs, labels = big
    rows = TX.classify(docs, labels).collect()
    assert all(r["held_out"] == held_out(r["doc_id"], 4, 2) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    toxic, clean = accuracy(rows, {r["doc_id"]: r["toxic"] for r in labels.collect()})
    # about 8 % of these toxic labels are on texts without any telling word, and this table has 330 to learn from
    assert toxic > 0.8 and clean > 0.97


def test_language_on_held_out_rows(big):
    docs, _ = big
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in LG.identify(docs).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) > 0.97 * len(rows)


def test_labels_of_held_out_rows_change_nothing(spark, docs001, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = TX.train(docs001, labels), TX.train(docs001, flipped)
    assert np.array_equal(one.table, two.table) and one.knots == two.knots


def test_edge_rows_are_all_scored(spark, edge_docs, no_docs, sf_dir):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(30)] + [(None, 1, 1), (3, None, None), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    ids = Counter(r["doc_id"] for r in edge_docs.collect())
    for out in (QL.classify(edge_docs, labels), TX.classify(edge_docs, labels), LG.identify(edge_docs)):
        rows = out.collect()
        assert Counter(r["doc_id"] for r in rows) == ids
        assert all(0.0 <= r["score"] <= 1.0 for r in rows)
    for out in (QL.classify(no_docs, labels), TX.classify(no_docs, labels), LG.identify(no_docs)):
        assert out.count() == 0
    none = labels.where("false")
    assert {r["score"] for r in QL.classify(edge_docs, none).collect()} == {0.5}
    assert {r["score"] for r in TX.classify(edge_docs, none).collect()} == {0.0}
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect() if r["doc_id"] is not None}
    for r in LG.identify(edge_docs).collect():
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[r["doc_id"]] or ""))
    for kept in (TX.drop_toxic(edge_docs, labels), LG.keep_identified(edge_docs)):
        assert kept.columns == edge_docs.columns


def test_factorisation_machine_identity():
    fm = QL.FactorisationMachine()
    rng = np.random.default_rng(1)
    fm.w = rng.standard_normal(QL.DIMS)
    docs = [(np.sort(rng.choice(QL.DIMS, 6, replace=False)), rng.random(6)) for _ in range(3)]
    z, _ = fm.logits(*QL.joined(docs))
    for (rows, x), got in zip(docs, z):
        pairs = sum(fm.v[rows[i]] @ fm.v[rows[j]] * x[i] * x[j] for i in range(6) for j in range(i))
        assert math.isclose(got, fm.b + fm.w[rows] @ x + pairs, rel_tol=1e-9)


def test_filter_maxima_do_not_depend_on_chunks(monkeypatch):
    cnn = TX.TextCNN()
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, TX.DIM)).astype(np.float32)
    ids = np.arange(500)
    whole = cnn.maxima(ids, x.__getitem__)
    monkeypatch.setattr(TX, "CHUNK", 7)
    parts = cnn.maxima(ids, x.__getitem__)
    assert np.allclose(whole[0], parts[0], atol=1e-4)
    for i, w in enumerate(TX.WIDTHS):
        y = np.array([(x[t:t + w, :, None] * cnn.filters[w]).sum(axis=(0, 1)) for t in range(len(x) - w + 1)])
        assert np.allclose(whole[0][i * TX.FILTERS:(i + 1) * TX.FILTERS], np.maximum(0, y.max(axis=0)), atol=1e-4)


def test_word_contributions_give_the_linear_score():
    rng = random.Random(3)
    docs = ["the cat sat on the mat " * rng.randint(1, 3) for _ in range(20)] + ["der hund und die katze " * rng.randint(1, 3) for _ in range(20)]
    coded = []
    for d in docs:
        rows, counts = np.unique(LG.gram_rows(d.split())[0], return_counts=True)
        coded.append((rows, counts.astype(float)))
    model = LG.LanguageModel(["de", "en"]).fit(coded, np.array([1] * 20 + [0] * 20))
    frozen, w = model.frozen(), model.weights()
    assert (w == 0).mean() > 0.9
    for d, (rows, counts) in zip(docs, coded):
        logits = LG.SCALE * (counts / counts.sum() * model.idf[rows]) @ w[rows] + model.bias
        got = frozen.contributions(d.split()).sum(axis=0)
        assert np.allclose(got[:-1] / got[-1] + frozen.bias, logits)
        assert frozen.predict(got)[0] == ("en" if "cat" in d else "de")
    assert LG.FrozenModel([], np.zeros((0, 0)), np.zeros(0), 1.0).predict(np.array([1.0])) == ("und", 0.0)


def test_grams_of_marked_runs():
    rows, owner = LG.gram_rows(["ab-c1", "", "##", "é"])
    # runs ab, c and é: three grams a letter and one more a run
    assert np.bincount(owner, minlength=4).tolist() == [3 * 3 + 2, 0, 0, 4]
    assert LG.gram_rows(["ab"])[0].tolist() == LG.gram_rows(["-ab"])[0].tolist()
    assert set(LG.gram_rows(["ab"])[0]) & set(LG.gram_rows(["b"])[0])
    assert LG.gram_rows([])[0].tolist() == []


def test_thresholds_do_not_depend_on_the_class_mix_of_the_sample():
    rng = np.random.default_rng(6)
    n = {0: 40_000, 1: 5_000}
    y = np.repeat([0.0, 1.0], [n[0], n[1]])
    p = TX.sigmoid(rng.standard_normal(len(y)) + 2.0 * y - 1.0)
    language = rng.integers(0, 2, len(y))
    capped = np.concatenate([rng.choice(np.flatnonzero(y == c), 4000, replace=False) for c in (0, 1)])

    def knots(at, weight=None):
        cnn = TX.TextCNN()
        cnn._calibrate(p[at], language[at], y[at], weight)
        return np.array([cnn.knots[k][0] for k in (0, 1)])
    every = knots(np.arange(len(y)))
    weighted = knots(capped, np.array([n[int(c)] / 4000 for c in y[capped]]))
    assert np.all(np.abs(weighted - every) < 0.08)
    assert np.all(every - knots(capped) > 0.15)  # 50/50 rows ask for a looser threshold


def test_calibration_rows_stand_for_all_rows_of_their_class(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i % 7} " + ("bad" if i % 8 == 0 else "good")) for i in range(600)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(600)], "doc_id bigint, toxic int")
    usable = Counter(int(i % 8 == 0) for i in range(600) if not held_out(i, 4, 2))
    seen = []
    monkeypatch.setattr(TX.TextCNN, "_calibrate", lambda self, p, language, y, weight=None: seen.extend(zip(y, weight)))
    TX.train(docs, labels, per_class=100)
    assert {int(c): w for c, w in seen} == {0: usable[0] / 100, 1: 1.0}


def test_toxicity_embeds_the_new_words_of_a_text_in_one_step():
    class Counted(TX.TextCNN):
        calls = 0

        def embed(self, rows):
            Counted.calls += 1
            return super().embed(rows)
    model = Counted()
    texts = [None, b"", b"one", "Ça (va) İstanbul x".encode(), " ".join(f"word{i}, a" for i in range(5000)).encode(), b"one word1, word7000"]
    for limit in (TX.CACHE_SCORED, 3):  # with few words kept, the others are embedded again
        words = TX.Embedded(model, limit)
        for text in texts:
            before = Counted.calls
            ids = words.encode(text)
            assert Counted.calls - before <= 1
            plain = [TX.features(w) for w in TX.words_of(text)]
            vectors = np.array([model.table[rows].sum(axis=0) for rows, _ in plain], np.float32).reshape(-1, TX.DIM)
            assert np.array_equal(words.vectors[ids], vectors) and words.marks[ids].tolist() == [m for _, m in plain]
            assert np.array_equal(model.activations(ids, words.vectors.__getitem__), model.maxima(ids, words.vectors.__getitem__)[0])
