"""Property checks (hypothesis) and small contracts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladle.functions import text as T
from ladle.operators import render as R

WS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　"
texts = st.text(alphabet=st.sampled_from(list(WS) + list("ab é​{}")), max_size=12)


@settings(max_examples=30, deadline=None)
@given(st.lists(texts, min_size=1, max_size=20))
def test_py_strip_is_python_strip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.s for r in df.orderBy("i").select(T.py_strip("v").alias("s")).collect()]
    assert got == [v.strip() for v in values]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="abc <>/think\n", min_size=1, max_size=15), min_size=1, max_size=10))
def test_strip_undoes_wrap_for_plain_reasoning(spark, rs):
    plain = [r for r in rs if r.strip() and not r.strip().startswith("<think>") and "</think>" not in r]
    if not plain:
        return
    df = spark.createDataFrame([(r,) for r in plain], "r string")
    out = [x.s for x in df.select(T.strip_reasoning(R.assistant_turn("r", F.lit('{"k":1}'))).alias("s")).collect()]
    assert out == ['{"k":1}'] * len(plain)


def test_to_chat_missing_positions_give_null(spark):
    df = spark.createDataFrame([([("system", "s"), ("user", "u")],)], "m array<struct<role:string,content:string>>")
    row = df.select(R.to_chat("m").alias("c"), R.chat_complete("m").alias("ok")).first()
    assert row.c[2].content is None and row.ok is False


def test_cluster_needs_a_shared_checkpoint_folder(monkeypatch, spark):
    from ladle import session as S
    monkeypatch.setattr(S, "_is_local", lambda _s: False)
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    asked = spark.conf.get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: default[0] if key == "spark.checkpoint.dir" else asked(key, *default))
    with pytest.raises(RuntimeError):
        S.checkpoint_dir(spark)


def test_enrich_isolates_failures(spark):
    from ladle.operators.enrich import enrich, map_batches

    def shout(values):
        if any(v is None for v in values):
            raise ValueError("missing value")
        return [v.upper() for v in values]
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"w{i}") for i in range(23)], "id int, t string")
    out = {r.id: (r.result, r.error) for r in enrich(df, shout, "t", ["id"], batch=4).collect()}
    assert len(out) == 23
    assert out[1] == ("W1", None) and out[0][0] is None and out[0][1].startswith("ValueError")
    assert sum(1 for r, e in out.values() if e) == 5

    def lengths(pdf):
        return pdf.assign(n=pdf["t"].str.len())[["id", "n"]]
    m = map_batches(df.fillna("x"), lengths, "id int, n long").collect()
    assert sorted(r.n for r in m)[0] == 1


def test_failed_judge_calls(spark):
    from ladle.operators.score import normalize_judge
    from ladle.operators.summary import score_summary
    df = spark.createDataFrame([(1, '{"scores": {"overall": 8}}', None), (2, None, "timeout"), (3, "no json", None)],
                               "sample_id int, raw string, err string")
    j = {r.sample_id: r.judge for r in normalize_judge(df, call_error="err").collect()}
    assert j[1].scores.overall == 8.0 and j[1].error is None
    assert j[2].scores.overall == 0.0 and j[2].error == "API call failed: timeout" and j[2].raw is None
    assert j[3].scores.overall is None and j[3].error == "Could not extract JSON from response" and j[3].raw == "no json"
    flat = normalize_judge(df, call_error="err").select(
        F.lit(True).alias("evaluated"), F.col("judge.scores.overall").alias("overall"), F.col("judge.error").alias("e"))
    keep = score_summary(flat).first()
    assert keep.vibes_evaluated_count == 3 and keep.vibes_avg_score == 4.0
    drop = score_summary(flat, judge_error="e", errors_as_null=True).first()
    assert drop.vibes_avg_score == 8.0


def test_outcome_route_shapes(spark):
    from ladle.operators.route import outcome
    vals = [None, "{}", "[]", '""', "0", "null", '{"a":1}', "[1]", '"text"', "nope"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, recipe_json string")
    got = [r.outcome for r in df.withColumn("outcome", outcome()).orderBy("i").collect()]
    assert got == ["failed", "empty", "empty", "empty", "empty", "empty", "good", "error", "error", "error"]


def test_order_score_of_long_lists(spark):
    import random
    import time

    from ladle.operators.score import _places
    rng = random.Random(3)
    cases = [([rng.choice("abcdef") for _ in range(rng.randrange(9))], [rng.choice("abcxyz") for _ in range(rng.randrange(9))]) for _ in range(300)]
    cases += [([], []), (["a"], []), ([], ["a"]), (["a", None], [None, "a"]), ([str(i) for i in range(3000)], [str(i) for i in range(2999, -1, -1)])]
    df = spark.createDataFrame([(i, s, x) for i, (s, x) in enumerate(cases)], "i int, s array<string>, x array<string>")
    got = {r["i"]: r["p"] for r in df.select("i", _places(F.col("s"), F.col("x")).alias("p")).collect()}
    for i, (s, x) in enumerate(cases):
        distinct = list(dict.fromkeys(x))
        assert got[i] == [distinct.index(v) for v in s if v is not None and v in distinct], (s, x)

    def seconds(n):
        one = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda v: F.concat(F.lit("Add "), v.cast("string"))).alias("s"))
        t = time.perf_counter()
        assert one.select(F.size(_places(F.col("s"), F.reverse("s"))).alias("n")).first()["n"] == n
        return time.perf_counter() - t
    seconds(16_000)
    assert seconds(32_000) < 2.5 * max(seconds(16_000), 1.0)
