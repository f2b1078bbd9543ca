"""Scalar columns against Python's own behaviour."""

from pyspark.sql import functions as F

from ladle.functions import text as T
from ladle.operators import render as R


def one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r.o for r in df.orderBy("i").select(col(F.col("v")).alias("o")).collect()]


def test_py_strip_matches_python(spark):
    samples = ["  a b  ", " x ", "\x1c\x1dy\x85", "​z​", "\t\n\r\x0bq\x0c", ""]
    assert one(spark, T.py_strip, samples) == [s.strip() for s in samples]


def test_safe_name(spark):
    names = ['a/b\\c:d', 'q?*"<>|x', "x" * 201, "plain"]
    out = one(spark, T.safe_name, names)
    assert out[:2] == ["a-b-c-d", "qx"]
    assert len(out[2]) == 200 and out[3] == "plain"


def test_human_time(spark):
    assert one(spark, T.human_time, [0.0, 59.95, 60.0, 3600.0, 90.0], "double") == ["0.0s", "60.0s", "1.0m", "1.0h", "1.5m"]


def test_response_tail_and_outer_json(spark):
    cases = ['x\nmodel\nA\nmodel\n {"a": 1} ', '<start_of_turn>model{"b": 2}<end_of_turn>', "no brace here",
             'chat {"c": {"d": 3}} more']
    assert one(spark, T.extract_answer_json, cases) == ['{"a": 1}', '{"b": 2}', "no brace here", '{"c": {"d": 3}}']


def test_fenced_json(spark):
    cases = ['pre ```json\n{"a":1}\n``` post', '```\n{"b":2}\n```', '```json\n{"c":3}', 'say {"d":4} end', "none"]
    assert one(spark, T.fenced_json, cases) == ['{"a":1}', '{"b":2}', '{"c":3}', '{"d":4}', None]


def test_reasoning_wrap_and_strip(spark):
    rs = [None, "", "  plan  ", "<think>\nkept\n</think>", "a</think>\n\nb"]
    wrapped = one(spark, R.wrap_reasoning, rs)
    assert wrapped == [None, "", "<think>\nplan\n</think>", "<think>\nkept\n</think>", "<think>\na</think>\n\nb\n</think>"]
    df = spark.createDataFrame([(r, '{"x":1}') for r in rs], "r string, j string")
    turns = [x.t for x in df.select(R.assistant_turn("r", "j").alias("t")).collect()]
    assert turns[0] == 'None\n\n{"x":1}'
    stripped = [x.s for x in df.select(T.strip_reasoning(R.assistant_turn("r", "j")).alias("s")).collect()]
    # plain non-empty reasoning strips back to the JSON; empty leaves the blank line (kept, flagged)
    assert stripped[2] == '{"x":1}' and stripped[3] == '{"x":1}' and stripped[1] == '\n\n{"x":1}'
    # greedy: from the first <think> to the last </think> + blank line
    assert stripped[4] == '{"x":1}'


def test_no_blank_line_after_think_stays(spark):
    assert one(spark, T.strip_reasoning, ["<think>a</think>\n{}"]) == ["<think>a</think>\n{}"]


def test_preview(spark):
    assert one(spark, T.preview, ["x" * 201, "y" * 200]) == ["x" * 200 + "...", "y" * 200]


def test_chat_render(spark):
    conv = [("system", " sys "), ("user", "hi"), ("assistant", "<think>r</think>\n\n{}"), ("user", "again")]
    df = spark.createDataFrame([(conv,)], "m array<struct<role:string,content:string>>")
    text = df.select(R.render_chat("m").alias("t")).first().t
    assert text == ("<start_of_turn>user\nsys\n\nhi<end_of_turn>\n<start_of_turn>model\n<think>r</think>\n\n{}<end_of_turn>\n"
                    "<start_of_turn>user\nagain<end_of_turn>\n")
    gen = df.select(R.render_chat("m", add_generation_prompt=True).alias("t")).first().t
    assert gen.endswith("<start_of_turn>user\nagain<end_of_turn>\n<start_of_turn>model\n") and "{}" not in gen


def test_strip_header_and_reasoning_flags(spark):
    df = spark.createDataFrame([("<!-- Generated with style: x -->\n\nbody", "", '{"a":1}'),
                                ("plain", "<think>open", '{"b":2}')], "t string, r string, j string")
    rows = df.select(R.extraction_prompt("t", strip_header=True).alias("p"),
                     R.reasoning_flags(R.assistant_turn("r", "j")).alias("f")).collect()
    assert rows[0].p == R.EXTRACT_PREFIX + "body" and rows[1].p == R.EXTRACT_PREFIX + "plain"
    assert rows[0].f.leading_blank is True and rows[0].f.think_left is False
    assert rows[1].f.think_left is True


def test_supervised_spans_follow_markers(spark):
    text = ("<start_of_turn>user\nq<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>\n"
            "<start_of_turn>model\nB<end_of_turn>\n<start_of_turn>system\nS<end_of_turn>\n<start_of_turn>user\nz<end_of_turn>\n")
    df = spark.createDataFrame([(1, text)], "k int, text string")
    rows = [(r.masked, r.kept) for r in R.supervised_spans(df, "k").orderBy("seg").collect()]
    m = len(R.MODEL_MARK)
    seg_a = len("<start_of_turn>model\nA<end_of_turn>\n")
    seg_s = len("<start_of_turn>system\nS<end_of_turn>\n")
    # user masked; each model marker masked and its text kept; the system turn after a model turn is kept
    assert rows[1] == (m, seg_a - m) and rows[2] == (m, seg_a - m) and rows[3] == (0, seg_s)
    assert rows[0][1] == 0 and rows[4][1] == 0


def test_system_folds_into_first_user_turn(spark):
    conv = [("system", "S"), ("assistant", "hello"), ("user", "q")]
    df = spark.createDataFrame([(conv,)], "m array<struct<role:string,content:string>>")
    text = df.select(R.render_chat("m").alias("t")).first().t
    assert text == "<start_of_turn>model\nhello<end_of_turn>\n<start_of_turn>user\nS\n\nq<end_of_turn>\n"
