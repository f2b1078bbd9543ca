"""Six-axis scores (I3) on lists with repeats and NULLs, and the grouping of source records."""

import random

from pyspark.sql import functions as F

from ladle.operators import score as SC
from ladle.plans.views import v_recipes


def _distinct(xs):
    return list(dict.fromkeys(xs))


def _ratio(num, den):
    return num / den if den > 0 else 0.0


def _want(n, si, ss, sm, xn, xi, xs, xm):
    """The scores by the definition: (kind, value) pairs told apart by a prefix, NULL entries all one pair."""
    a, b = (_distinct(t.lower().split()) for t in (n, xn))
    found = [s for s in ss if s in xs and s is not None]
    pos = [xs.index(s) for s in found]
    share = 1.0 if len(pos) < 2 else sum(q > p for p, q in zip(pos, pos[1:])) / (len(pos) - 1)

    def pairs(name, ingredients, steps, meta):
        kinds = [("name:", name), ("ingredient:", _distinct(ingredients)), ("step:", steps)]
        return _distinct([v if v is None else k + v for k, vs in kinds for v in vs] + [f"m{i}:{m}" for i, m in enumerate(meta) if m is not None])
    ps, px = pairs(a, si, ss, sm), pairs(b, xi, xs, xm)
    both = len(set(ps) & set(px))
    p, r = _ratio(both, len(px)), _ratio(both, len(ps))
    parts = [10 * _ratio(len(set(a) & set(b)), len(set(a) | set(b))), 10 * _ratio(len(set(si) & set(xi)), len(set(si))),
             10 * _ratio(len(found), len(ss)) * share, 10 * _ratio(sum(s is not None and s == x for s, x in zip(sm, xm)), sum(s is not None for s in sm)),
             10 * (2 * p * r / (p + r) if p + r > 0 else 0.0)]
    return [*parts, sum(parts) / 5]


_SCHEMA = "id int, n string, si array<string>, ss array<string>, s0 string, s1 string, xn string, xi array<string>, xs array<string>, x0 string, x1 string"


def _scored(spark, rows):
    df = spark.createDataFrame(rows, _SCHEMA)
    c = F.col
    out = SC.add_scores(df, c("n"), c("si"), c("ss"), [c("s0"), c("s1")], c("xn"), c("xi"), c("xs"), [c("x0"), c("x1")])
    assert out.columns == [*df.columns, "scores"]
    return out


def test_scores_of_lists_with_repeats_and_nulls(spark):
    rnd, rows = random.Random(7), []
    for i in range(400):
        pool = [f"v{k}" for k in range(rnd.choice((2, 5, 12, 200)))] + [None] * (i % 3 == 0) + ["", "step:v1", "name:v1"]

        def some():
            return [rnd.choice(pool) for _ in range(rnd.choice((0, 1, 4, 9)))]
        ss = some() if i % 2 else _distinct(some())
        xs = some() if i % 5 else rnd.sample(ss, len(ss))
        rows.append((i, " ".join(rnd.choice("aBc") for _ in range(i % 4)), some(), ss, rnd.choice(("u", None)), rnd.choice(("u", "w", None)),
                     rnd.choice(("A b", "c", "")), some(), xs, rnd.choice(("u", None)), rnd.choice(("u", "w", None))))
    for r in _scored(spark, rows).collect():
        want = _want(r["n"], r["si"], r["ss"], [r["s0"], r["s1"]], r["xn"], r["xi"], r["xs"], [r["x0"], r["x1"]])
        assert [abs(g - w) < 2e-6 for g, w in zip(r["scores"], want)] == [True] * 6, (r, want)


def test_scores_of_missing_lists(spark):
    rows = [(0, None, ["a"], ["s"], "u", None, "n", ["a"], ["s"], "u", None), (1, "n", None, ["s"], "u", None, "n", ["a"], ["s"], "u", None),
            (2, "n", ["a"], None, "u", None, "n", ["a"], ["s"], "u", None), (3, "n", ["a"], ["s"], "u", None, "n", ["a"], None, "u", None)]
    got = {r["id"]: tuple(r["scores"]) for r in _scored(spark, rows).collect()}
    assert got == MISSING


# as before the counts were added up: missing names and ingredients score 0 on their axis, missing steps NULL, all of them 0 on completeness
MISSING = {0: (0.0, 10.0, 10.0, 10.0, 0.0, 6.0), 1: (10.0, 0.0, 10.0, 10.0, 0.0, 6.0),
           2: (10.0, 10.0, None, 10.0, 0.0, None), 3: (10.0, 10.0, None, 10.0, 0.0, None)}


def test_pairs_are_not_built_as_texts(spark):
    plan = _scored(spark, [(0, "n", ["a"], ["s"], "u", None, "n", ["a"], ["s"], "u", None)])._jdf.queryExecution().executedPlan().toString()
    assert "ingredient:" not in plan and "step:" not in plan


def test_source_records_are_grouped_once(spark, tmp_path):
    li = "l_partkey bigint, l_orderkey bigint, l_quantity double, l_returnflag string, l_linestatus string"
    lines = [(1, 10, 2.0, "N", "O"), (1, 10, 1.0, "N", "O"), (1, None, 3.0, "N", "O"), (1, 11, None, "N", "O"), (2, None, 1.0, None, "O"), (None, 5, 1.0, "N", "O")]
    spark.createDataFrame(lines, li).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "p", "t", "b", 4), (2, "q", "t", "b", 5)], "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    df = v_recipes(spark, str(tmp_path))
    assert sorted((r["rid"], r["n_rater"], r["n_reviewer"], r["ingredient"]) for r in df.collect()) == [("1", "4", "2", "1 x NO 10; 2 x NO 10"), ("2", "1", "0", "")]
    assert df._jdf.queryExecution().sparkPlan().toString().count("Aggregate(") == 2  # a partial and a final one, none by (part, order)
