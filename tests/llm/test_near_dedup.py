"""Near-duplicate groups, components and pruning against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from ladle.llm import near_dedup as ND
from ladle.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """doc index -> (n_shingles, component id) by comparing all pairs of distinct sets."""
    sets = [shingles(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=lambda s: (len(s), sorted(s)))
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(distinct):
        for j in range(i):
            b = distinct[j]
            if 100 * len(b) >= 85 * len(a):
                common = len(a & b)
                if 100 * common >= 85 * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    at = {s: i for i, s in enumerate(distinct)}
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            k = find(at[s])
            least[k] = min(least.get(k, doc_id), doc_id)
    return Counter((d, len(s), least.get(find(at[s])) if s else d) for (d, _), s in zip(rows, sets))


def near_copies(n=40, length=200, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(length)]
    out = [" ".join(base)]
    for k in range(n):
        w = list(base)
        for _ in range(1 + k % 7):
            w[rng.randrange(length)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("which", ["edge_docs", "docs001"])
def test_groups_match_brute_force(which, request):
    docs = request.getfixturevalue(which)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ND.deduplicate(docs).collect())
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_large_group_of_near_copies(spark):
    rows = [(1000 - i, t) for i, t in enumerate(near_copies() + near_copies(30, 60, 2) + near_copies(30, 500, 3))]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ND.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == brute(rows)


def test_joins_beyond_the_broadcast_bounds(spark, monkeypatch):
    from ladle.llm import components as CC
    monkeypatch.setattr(ND, "MAX_BROADCAST_TEXTS", 0)
    monkeypatch.setattr(CC, "MAX_BROADCAST_NODES", 0)
    monkeypatch.setattr(ND, "BLOCK_BYTES", 4096)
    rows = [(i, t) for i, t in enumerate(near_copies(20, 100, 5) + near_copies(5, 30, 6) * 2)] + [(None, near_copies(1, 30, 6)[0])]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ND.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == brute(rows)


def test_one_of_each_group_stays(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    kept = ND.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    heads = {c for (_, n, c) in brute(rows) if n}
    blank = Counter((d, t) for d, t in rows if not shingles(t))
    assert Counter({k: v for k, v in got.items() if not shingles(k[1])}) == blank
    assert sorted(k[0] for k, v in got.items() if shingles(k[1]) for _ in range(v)) == sorted(heads)
    assert ND.drop_near_duplicates(no_docs).count() == 0
    assert ND.deduplicate(no_docs).count() == 0


def test_pruning_follows_the_posterior():
    t = 0.85
    m = ND.least_matches(24, t)
    grid = np.linspace(0, 1, 200_001)

    def posterior(k):
        density = grid ** k * (1 - grid) ** (24 - k)
        return density[grid >= t].sum() / density.sum()
    assert posterior(m) >= ND.MISS * 0.9 and posterior(m - 1) < ND.MISS * 1.1
    others = np.zeros((3, ND.HASHES), np.uint8)
    others[1, :] = 1
    others[2, : ND.HASHES // 10] = 1
    assert ND.survivors(np.zeros(ND.HASHES, np.uint8), others).tolist() == [0, 2]


def test_families_in_many_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ND, "BLOCK_MEMBERS", 7)
    rows = [(i, t) for i, t in enumerate(near_copies(60, 150, 9) + near_copies(5, 40, 10))]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ND.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == brute(rows)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(2000, 2000), (7, 3000)]
    rng.shuffle(edges)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 3000: 0, **{k: 1000 for k in range(1000, 1100)}}


def test_the_pipeline_drops_at_80_percent(spark):
    def edited(n, at, mark):
        return " ".join(f"x{mark}" if k in at else f"{mark}w{k}" for k in range(n))
    # similarity 106/126, exactly 40/50, and 101/131
    pairs = [(120, (30, 80)), (49, (20,)), (120, (20, 60, 100))]
    rows = [(10 * i + k, edited(n, at if k else (), f"d{i}")) for i, (n, at) in enumerate(pairs) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in ND.drop_near_duplicates(docs).collect()) == [0, 10, 20, 21]
    assert all(r["kept"] for r in ND.deduplicate(docs).collect())  # op3 stays at 85 %
    assert (ND.bands_for(85), ND.bands_for(80)) == (ND.BANDS, 35)
    assert (1 - 0.8 ** ND.ROWS) ** ND.bands_for(80) < 1e-6
