"""Nearest neighbours against brute force; packing as an exact round trip."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ladle.llm import packing as PK
from ladle.llm import vptree as VP


def brute_nearest(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = set()
    for i, q in good:
        if i % 50:
            continue
        scored = sorted(((-(v * q).sum() / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum())), j) for j, v in good if j != i and len(v) == len(q)))
        out |= {(i, r, j, round(-s, 9)) for r, (s, j) in enumerate(scored[:k], 1)}
    return out


def found(df):
    return {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.collect()}


@pytest.mark.parametrize("shard_rows", [8192, 100])
def test_factor_one_is_exact(spark, sf_dir, shard_rows):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert found(VP.nearest(table, F.col("id") % 50 == 0, shard_rows=shard_rows)) == brute_nearest(rows)


def test_vector_edge_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(400)]  # one very common vector
    rows += [(50 * k, [1.0, 0.0, 0.0, float(k % 3)]) for k in range(30, 36)]
    rows += [(5000, None), (5050, [0.0] * 4), (5100, [float("nan"), 1.0, 1.0, 1.0]), (5150, [float("inf"), 1.0, 1.0, 1.0]), (5200, [None, 1.0, 1.0, 1.0]),
             (5250, []), (None, [1.0, 1.0, 1.0, 1.0]), (5300, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<double>, shard string, kind string")
    assert found(VP.nearest(df, F.col("id") % 50 == 0, shard_rows=200)) == brute_nearest(rows)
    assert VP.nearest(df.where("false"), F.col("id") % 50 == 0).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id bigint, embedding array<double>")
    assert found(VP.nearest(few, F.col("id") % 50 == 0)) == brute_nearest(rows[:3])


def test_pruning_and_recall():
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((40, 16))
    vectors = np.repeat(centers, 100, axis=0) + 0.1 * rng.standard_normal((4000, 16))
    tree = VP.VPTree(np.arange(4000), vectors)
    queries = np.arange(0, 4000, 50)
    exact = tree.search(queries, vectors[queries], 5)
    rough = tree.search(queries, vectors[queries], 5, relax=2.0)
    same = sum(len({i for _, i in a} & {i for _, i in b}) for a, b in zip(exact, rough))
    assert same >= 0.9 * 5 * len(queries)


def check_round_trip(docs, rows, window=PK.WINDOW):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PK.default_tokenizer())
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(t.encode(r["text"] or "", add_special_tokens=False).ids) + (1,)) for r in docs)
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] > 0
        sequences[r["sequence_id"]].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces[:-1]]).tolist()
        total = sum(r["length"] for r in pieces)
        assert total <= window and total & (total - 1) == 0  # full, or a power of two: no padding at all
    assert sum(r["length"] for r in rows) == sum(len(ids) for _, _, ids in want)
    crcs = defaultdict(list)
    for r in rows:
        crcs[(r["doc_id"], r["doc_tokens"])].append((r["start"], r["length"], r["ids_crc32"]))
    by_doc = defaultdict(list)
    for none, doc_id, ids in want:
        by_doc[(None if none else doc_id, len(ids))].append(ids)
    assert crcs.keys() == by_doc.keys()
    for key, texts in by_doc.items():
        if len(texts) == 1:
            at = 0
            for start, length, crc in sorted(crcs[key]):
                assert start == at and crc == zlib.crc32(np.array(texts[0][start:start + length], "<u4").tobytes())
                at += length
            assert at == len(texts[0])


@pytest.mark.parametrize("which", ["edge_docs", "docs001"])
def test_packing_round_trip(which, request):
    docs = request.getfixturevalue(which)
    check_round_trip(docs.collect(), PK.pack_documents(docs, shard_docs=37).collect())


def test_shards_are_bounded_by_tokens(edge_docs, monkeypatch):
    monkeypatch.setattr(PK, "SHARD_TOKENS", 3000)
    check_round_trip(edge_docs.collect(), PK.pack_documents(edge_docs).collect())


def test_runs_of_texts_are_bounded():
    from ladle.llm.texts import slices
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c" * 10, "d" * 10, "é" * 30])
    assert list(slices(texts, rows=3, size=25)) == [(0, 2), (2, 1), (3, 3), (6, 1)]
    assert list(slices(texts[2:], rows=2, size=1000)) == [(0, 2), (2, 2), (4, 1)]
    assert list(slices(texts[:0])) == []


def test_empty_table_packs_to_nothing(no_docs):
    assert PK.pack_documents(no_docs).count() == 0


def test_words_are_encoded_as_in_the_whole_text():
    e = PK.Encoder(PK.default_tokenizer())
    for text in ["a\x0bb c\x1cd e\x85f g\xa0h", "x <|endoftext|> y<|startoftext|>z", "don't DON'T we'll 's l'été ÉTÉ Straße İx K Å été", "12ab34 a1!b2?? ...''' ²½ ªº µ ŐŰ ΣΑΣ",
                 "日本語 テキスト 😀👍🏽 ​zero", "", " \n ", "a" * 5000]:
        want = e.tokenizer.encode(text, add_special_tokens=False).ids
        assert e.encode(pa.array([text, "a b", text])[1:])[1].tolist() == [*want, PK.END_ID], text


def test_neighbours_are_ranked_by_bm25():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 200, rng.integers(5, 60)).astype("<u2") for _ in range(40)]
    idf = rng.random(1 << 16).astype(np.float32) + 0.5
    index = PK.Index(docs, idf, 30.0)
    terms = index.query[7]

    def weight(d):
        total = 0.0
        for t in terms:
            tf = int((docs[d] == t).sum())
            total += idf[t] * tf * (PK.K1 + 1) / (tf + PK.K1 * (1 - PK.B + PK.B * len(docs[d]) / 30.0)) if tf else 0.0
        return total
    scores = np.array([weight(d) for d in range(40)])
    got = index.neighbours(7)
    assert set(got) == set(np.flatnonzero(scores > 0))
    assert np.all(np.diff(scores[got]) <= 1e-4)


@pytest.mark.parametrize("layout", ["apart", "together"])
def test_neighbours_come_from_all_partitions(spark, layout):
    rng = np.random.default_rng(3)
    vocab = [a + b + c for a in "bdfgklmnpr" for b in "aeiou" for c in ["st", "nd", "rk", "lt", "m", "x"]]
    rows = []
    for i in range(1200):
        topic = i % 30 if layout == "apart" else i // 40
        own = [vocab[10 * topic + k] for k in rng.integers(0, 10, 24)]
        rows.append((i, topic, " ".join(own + [str(w) for w in rng.choice(["the", "and", "of", "to"], 12)])))
    docs = spark.createDataFrame(rows, "doc_id bigint, topic int, text string").repartitionByRange(6, "doc_id")
    packed = PK.pack_documents(docs, window=256, shard_docs=100).collect()
    check_round_trip(docs.collect(), packed, window=256)
    topic_of, windows = {r[0]: r[1] for r in rows}, defaultdict(list)
    for r in packed:
        windows[r["sequence_id"]].append((r["offset"], topic_of[r["doc_id"]]))
    others = [t == min(w)[1] for w in windows.values() for o, t in w if o]
    assert len(others) > 600 and np.mean(others) > 0.75


def test_tokenizer_is_read_once_for_all_tasks_of_a_worker():
    path = PK.default_tokenizer()
    warm = PK.encoder_of(path)
    assert PK.encoder_of(path) is warm
    first, again = (pa.array(x) for x in (["Some words, some (other) words", ""], ["", "other words; Some"]))
    for texts in (first, again, first):
        assert [x.tolist() for x in warm.encode(texts)] == [x.tolist() for x in PK.Encoder(path).encode(texts)]
