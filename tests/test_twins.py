"""Each scalar column and its DuckDB twin agree on edge inputs beyond the fixtures."""

import duckdb
import pytest
from pyspark.sql import functions as F

from ladle.functions import jsondoc as J
from ladle.functions import text as T
from ladle.sources import io as IO

EDGE = [None, "", " ", "\t\n x  ", "plain", "a/b\\c:d?*\"<>|e", "é" * 205,
        "user\nmodel\nA\nmodel\n {\"a\": 1} ", "<start_of_turn>model{\"b\": [1, {\"c\": 2}]}<end_of_turn>",
        "pre ```json\n{\"x\":1}\n``` post", "```\n{\"y\":2}\n```", "```json\n{\"z\":3", "say {\"d\":4} end {x}",
        "<think>r</think>\n\n{\"k\":1}", "<think>a</think>\n<think>b</think>\n\n{}", "no brace", "a.b.txt", ".hidden", "x."]

PAIRS = [
    (T.py_strip, T.sql_py_strip), (T.safe_name, T.sql_safe_name), (T.preview, T.sql_preview),
    (T.strip_reasoning, T.sql_strip_reasoning), (T.response_tail, T.sql_response_tail),
    (T.extract_answer_json, T.sql_extract_answer_json), (T.fenced_json, T.sql_fenced_json),
    (IO.path_stem, IO.sql_path_stem),
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("CREATE TABLE t (i INTEGER, v VARCHAR)")
    c.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(EDGE)))
    return c


@pytest.mark.parametrize("fn,sql", PAIRS, ids=[p[0].__name__ for p in PAIRS])
def test_text_twins(spark, con, fn, sql):
    df = spark.createDataFrame(list(enumerate(EDGE)), "i int, v string")
    got = [r.o for r in df.orderBy("i").select(fn(F.col("v")).alias("o")).collect()]
    want = [r[0] for r in con.execute(f"SELECT {sql('v')} FROM t ORDER BY i").fetchall()]
    assert got == want


def test_human_time_twin(spark):
    xs = [0.0, 0.05, 0.25, 59.94, 59.95, 60.0, 61.5, 3599.0, 3600.0, 7261.3]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, v double")
    got = [r.o for r in df.orderBy("i").select(T.human_time("v").alias("o")).collect()]
    c = duckdb.connect()
    want = [c.execute(f"SELECT {T.sql_human_time(repr(x))}").fetchone()[0] for x in xs]
    assert got == want


def test_repair_ladder_twin(spark, con):
    docs = ['{"a":1}', ' {"a":1} ', '{"a":1} x', '{"a":1,}', '[1,2,]', '{"a":[1,2', '{"a":"b', '```json\n{"a":1}\n```',
            'text {"a":{"b":1}} more', "", "nothing", '{"a":NaN}', "[]", '"s"', "null", '{"a":1}{"b":2}']
    df = spark.createDataFrame(list(enumerate(docs)), "i int, v string")
    got = [(r.outcome, r.json_text) for r in J.parse_tolerant(df, "v", text="json_text").orderBy("i").collect()]
    c = duckdb.connect()
    c.execute("CREATE TABLE d (i INTEGER, v VARCHAR)")
    c.executemany("INSERT INTO d VALUES (?, ?)", list(enumerate(docs)))
    from ladle.operators.validate import sql_tolerant_ctes
    ctes = sql_tolerant_ctes("d", "i", "v", out="p")
    sql = "WITH " + ",\n".join(f"{n.rstrip('!')} AS ({b})" for n, b in ctes) + " SELECT outcome, json_text FROM p ORDER BY i"
    want = [tuple(r) for r in c.execute(sql).fetchall()]
    assert got == want


def test_validator_twin(spark):
    import json

    from ladle.operators.validate import sql_validate_ctes, validate
    from tests.test_validate import FULL
    base = dict(FULL)
    docs = [json.dumps(FULL), json.dumps({k: v for k, v in base.items() if k != "name"}),
            json.dumps({**base, "@type": "Article"}), json.dumps({**base, "@type": 3}),
            json.dumps({**base, "@context": "http://schema.org"}), json.dumps({**base, "name": None}),
            json.dumps({**base, "name": 5}), json.dumps({**base, "description": "  \t"}),
            json.dumps({**base, "recipeIngredient": "flour"}), json.dumps({**base, "recipeIngredient": ["flour", 2, None]}),
            json.dumps({**base, "recipeIngredient": []}),
            json.dumps({**base, "recipeInstructions": ["stir", {"text": "x"}, {"@type": "Step", "text": 1},
                                                      {"@type": None, "text": " "}, {"@type": True}, None]}),
            json.dumps({**base, "prepTime": "15 minutes", "cookTime": "PT", "totalTime": 5}),
            '[{"@context": "https://schema.org"}]', '"just text"', "", "nothing here", '{"a": 1} trailing',
            '{"name": "x", "a": [1, 2', "{}"]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, v string")
    got = [(r.outcome, list(r.errors), list(r.warnings)) for r in validate(df, "v").orderBy("i").collect()]
    c = duckdb.connect()
    c.execute("CREATE TABLE d (i INTEGER, v VARCHAR)")
    c.executemany("INSERT INTO d VALUES (?, ?)", list(enumerate(docs)))
    ctes = sql_validate_ctes("d", "i", "v")
    sql = ("WITH " + ",\n".join(f"{n.rstrip('!')} AS {'MATERIALIZED ' if n.endswith('!') else ''}({b})" for n, b in ctes)
           + " SELECT outcome, errors, warnings FROM validated ORDER BY i")
    want = [(o, list(e), list(w)) for o, e, w in c.execute(sql).fetchall()]
    assert got == want


def test_render_twin(spark):
    from ladle.operators import render as R
    from ladle.plans.q_render import _sql_render
    convs = [[("system", " S "), ("user", "q"), ("assistant", "a")],
             [("system", "S"), ("assistant", "hello"), ("user", "q")],
             [("user", " only ")], [("system", "alone")],
             [("assistant", "x"), ("assistant", "y"), ("user", "z")]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(convs)], "i int, m array<struct<role:string,content:string>>")
    got = [(r.a, r.b) for r in df.orderBy("i").select(R.render_chat("m").alias("a"),
                                                      R.render_chat("m", add_generation_prompt=True).alias("b")).collect()]
    c = duckdb.connect()
    c.execute("CREATE TABLE chats (i INTEGER, m STRUCT(role VARCHAR, content VARCHAR)[])")
    for i, conv in enumerate(convs):
        c.execute("INSERT INTO chats VALUES (?, ?)", [i, [{"role": r, "content": t} for r, t in conv]])
    want = [tuple(r) for r in c.execute(f"SELECT {_sql_render('m', False)}, {_sql_render('m', True)} FROM chats ORDER BY i").fetchall()]
    assert got == want
