"""Golden rows: inputs and expected outputs written out, independent of the rules' code on either side."""

import duckdb
from pyspark.sql import functions as F

from ladle.functions import jsondoc as J
from ladle.operators.validate import sql_tolerant_ctes

DEEP = 50
LONG = 1_000_000

# input -> (outcome, the text that parsed)
REPAIRS = {
    '{"a":1}': ("ok", '{"a":1}'),
    '{"a":1} tail': ("repaired", '{"a":1}'),
    '{"s":[{"t":"a"},{"t":"b","x":"c': ("repaired", '{"s":[{"t":"a"},{"t":"b","x":"c"}]}'),
    '{"a":",]b, }c",}': ("repaired", '{"a":",]b, }c"}'),
    '{"a":[1,{"b":2},': ("repaired", '{"a":[1,{"b":2}]}'),
    'Sure: {"a":[1,2': ("repaired", '{"a":[1,2]}'),
    '```json\n{"a":1,}\n```': ("repaired", '{"a":1}'),
    '}{"a":1': ("repaired", '{"a":1}'),
    '{"a":"b\\': ("repaired", '{"a":"b"}'),
    '{"a":"b\\\\': ("repaired", '{"a":"b\\\\"}'),
    '{"a":"say \\"hi': ("repaired", '{"a":"say \\"hi"}'),
    '{"a":' * DEEP + "1": ("repaired", '{"a":' * DEEP + "1" + "}" * DEEP),
    '{"a":[1}': ("rejected", None),
    '{"a":1}}': ("rejected", None),
    "no json": ("rejected", None),
    "": ("rejected", None),
}
HUGE = {
    '{"a":"' + "x" * LONG: ("repaired", '{"a":"' + "x" * LONG + '"}'),
    '{"a":"' + "\\n" * (LONG // 2) + '","b":[1,': ("repaired", '{"a":"' + "\\n" * (LONG // 2) + '","b":[1]}'),
}
# what only the token rungs can parse; DuckDB's regular expressions cannot say this, so there is no twin
TOKEN_REPAIRS = {
    "{'a': 1}": ("repaired", '{"a":1}'),
    "{a: 1}": ("repaired", '{"a":1}'),
    '{"a":1 "b":2}': ("repaired", '{"a":1,"b":2}'),
    '{"a":1, // c\n "b":2}': ("repaired", '{"a":1,"b":2}'),
    '{"a": 1 /* c } */, "b": 2 # t\n}': ("repaired", '{"a":1,"b":2}'),
    '{"a":"he said "hi" now"}': ("repaired", '{"a":"he said \\"hi\\" now"}'),
    '{name: "Say "hi", he said", n: 2 cups}': ("repaired", '{"name":"Say \\"hi\\", he said","n":"2 cups"}'),
    "{'a': 'it's', 'b': None, 'c': True, 'd': [False, undefined]}": ("repaired", '{"a":"it\'s","b":null,"c":true,"d":[false,null]}'),
    "{a: NaN}": ("rejected", None),
    "{'a': 'it\\'s \"so\"'}": ("repaired", '{"a":"it\'s \\"so\\""}'),
    '{"a":[1 2 3], b: [x, y z,],}': ("repaired", '{"a":[1,2,3],"b":["x","y z"]}'),
    '{"a":"x" "b":[ "p" "q" "r" ] "c":{"d":1}{"e":2}}': ("rejected", None),
    '{"a":"x" "b":[ "p" "q" "r" ] "c":{"d":1}}': ("repaired", '{"a":"x","b":["p","q","r"],"c":{"d":1}}'),
    "{\u201ca\u201d: \u201cb \"c\"\u201d}": ("repaired", '{"a":"b \\"c\\""}'),
    '{"a":,"b":}': ("repaired", '{"a":null,"b":null}'),
    '{,"a":1,,"b":[,2,,]}': ("repaired", '{"a":1,"b":[2]}'),
    '{"a":"x\ny\tz"}': ("repaired", '{"a":"x\\ny\\tz"}'),
    '{"a":"b\\q"}': ("repaired", '{"a":"bq"}'),
    "Sure! {'a': {'b': 'c": ("repaired", '{"a":{"b":"c"}}'),
    "```json\n{'a': 1}\n``` done": ("repaired", '{"a":1}'),
    '{"a": True, "b": [None, False': ("repaired", '{"a":true,"b":[null,false]}'),
    '{a: 007, b: -1.5e3, c: 1.}': ("repaired", '{"a":"007","b":-1.5e3,"c":"1."}'),
    "'no' json": ("rejected", None),
    "{a: [1}": ("rejected", None),
    "{a: 1}}": ("rejected", None),
}
TOKEN_HUGE = {
    "{'a':'" + "x'y " * (LONG // 4) + "'}": ("repaired", '{"a":"' + "x'y " * (LONG // 4) + '"}'),
    "{a: [" + "1 " * (LONG // 2) + "]}": ("repaired", '{"a":[' + ",".join("1" * (LONG // 2)) + "]}"),
    "{a: " + "[" * 300 + '"' + "\\" * (LONG + 1): ("repaired", '{"a":' + "[" * 300 + '"' + "\\" * LONG + '"' + "]" * 300 + "}"),
}


def test_token_repair(spark):
    cases = list({**TOKEN_REPAIRS, **TOKEN_HUGE}.items())
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: (r["outcome"], r["json_text"]) for r in J.parse_tolerant(df, "t").collect()}
    for i, (text, want) in enumerate(cases):
        assert got[i] == want, text[:60]


def test_repair_ladder(spark):
    cases = list({**REPAIRS, **HUGE}.items())
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: (r["outcome"], r["json_text"]) for r in J.parse_tolerant(df, "t").collect()}
    for i, (text, want) in enumerate(cases):
        assert got[i] == want, text[:60]


def test_repair_ladder_twin():
    con = duckdb.connect()
    con.execute("CREATE TABLE src (i INTEGER, t VARCHAR)")
    con.executemany("INSERT INTO src VALUES (?, ?)", [(i, t) for i, t in enumerate(REPAIRS)])
    ctes = ", ".join(f"{n.rstrip('!')} AS ({body})" for n, body in sql_tolerant_ctes("src", "i", "t"))
    got = con.execute(f"WITH {ctes} SELECT outcome, json_text FROM v_parsed ORDER BY i").fetchall()
    assert got == list(REPAIRS.values())


def test_spans_keep_every_character(spark):
    from ladle.operators.render import supervised_spans
    text = "a\x01b<start_of_turn>user\nq\x01<end_of_turn>\n<start_of_turn>model\nans\x01wer<end_of_turn>\n<start_of_turn>system\nx<start_of_turn>user\nbye"
    rows = supervised_spans(spark.createDataFrame([(1, text), (2, ""), (3, "<start_of_turn>model\nyes")], "k int, text string"), "k").collect()
    got = sorted((r["k"], r["seg"], r["length"], r["masked"], r["kept"]) for r in rows)
    # segments: plain text; user turn; model turn (21 marker characters masked); system turn after a model marker is kept; user turn
    assert got == [(1, 0, 3, 3, 0), (1, 1, 36, 36, 0), (1, 2, 42, 21, 21), (1, 3, 23, 0, 23), (1, 4, 23, 23, 0), (3, 0, 24, 21, 3)]
    assert sum(r["length"] for r in rows if r["k"] == 1) == len(text)


def test_only_good_records_become_examples(spark):
    from ladle.operators.route import examples, outcome
    cases = {'{"a":1}': "good", "{}": "empty", "{ }": "empty", "[]": "empty", "null": "empty", '""': "empty", "0": "empty", "0.0": "empty",
             "false": "empty", "true": "error", "[1]": "error", '"x"': "error", "7": "error", "{oops": "error", None: "failed"}
    rows = [(f"s{i}", t, "") for i, t in enumerate(cases)]
    records = spark.createDataFrame(rows, "stem string, recipe_json string, reasoning string")
    got = [r["o"] for r in records.orderBy(F.expr("int(substr(stem, 2))")).select(outcome().alias("o")).collect()]
    assert got == list(cases.values())
    blogs = spark.createDataFrame([(r[0], "text") for r in rows], "stem string, text string")
    assert [r["stem"] for r in examples(records, blogs).collect()] == ["s0"]


def test_example_rows_equal_the_matched_count(spark, sf_dir):
    import __spark_entry__ as E
    q = E.queries()
    assert q["training_example"](spark, sf_dir).count() == q["outcome_counts_pair"](spark, sf_dir).first()["matched_count"]


def _csv(tmp_path, name, data):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)
    return str(folder)


def test_csv_cells_read_as_written(spark, tmp_path):
    from ladle.sources import io as IO
    folder = _csv(tmp_path, "a.csv", "name,group\ncafé,\n\"\",\"  x \"\n lead,null\nshort\n".encode())
    folder = _csv(tmp_path, "b.csv", "name,group\ncafé,brûlée\n".encode("latin-1"))
    rows = IO.read_csv(spark, folder, row_error=True).collect()
    assert sorted((r["name"], r["group"] or "", r["group"] is None, r["_row_error"]) for r in rows) == sorted([
        ("café", "", False, None), ("", "  x ", False, None), (" lead", "null", False, None), ("short", "", True, "short"), ("café", "brûlée", False, None)])


def test_csv_writer_keeps_edge_spaces(spark, tmp_path):
    from ladle.sources import io as IO
    rows = [("  lead", "trail  "), ("", " "), ('q"', "a\nb")]
    IO.write_csv(spark.createDataFrame(rows, "name string, `group` string"), str(tmp_path / "o"))
    assert sorted(map(tuple, IO.read_csv(spark, str(tmp_path / "o")).collect())) == sorted(rows)


def test_json_dir_routes_bad_files(spark, tmp_path):
    from ladle.sources import io as IO
    for name, text in {"ok": '{"recipe": {"b": 1, "a": 2}, "reasoning": "w"}', "tail": '{"recipe": {}} x', "list": "[1]", "cut": '{"recipe": {',
                       "str": '{"recipe": "{}"}', "none": '{"reasoning": null}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = {r["stem"]: (r["recipe_json"], r["reasoning"], r["outcome"]) for r in IO.read_json_dir(spark, str(tmp_path)).collect()}
    assert got == {"ok": ('{"b":1,"a":2}', "w", "ok"), "tail": (None, None, "error"), "list": (None, None, "error"), "cut": (None, None, "error"),
                   "str": ('"{}"', "", "ok"), "none": (None, None, "ok")}


def test_whole_text_stream_is_named_by_file(spark, tmp_path):
    from ladle.streaming import ingest as ST
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"doc {i}.txt").write_bytes(b"line\r\ntwo")
    assert ST.ingest_stream(spark, src, out, ck, lambda d: d, fmt="files", files_per_trigger=1) == 3
    ST.ingest_stream(spark, src, out, ck, lambda d: d, fmt="files")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(f"doc {i}", "line\ntwo") for i in range(3)]


def test_null_is_not_missing(spark):
    df = spark.createDataFrame([('{"name":null}',), ('{"name":"x"}',), ("{}",), ('{"name":5}',)], "t string").select(J.parse_strict("t").alias("d"))
    got = [r["v"] for r in df.select(J.get_default("d", "$['name']", "Unknown").alias("v")).collect()]
    assert got == [None, "x", "Unknown", "5"]


def test_unique_names_follow_the_order(spark):
    from ladle.operators.names import unique_names
    cases = {("X_1", "X", "X"): ["X_1", "X", "X_2"], ("X", "X", "X_1"): ["X", "X_1", "X_1_1"], ("X", "X", "X"): ["X", "X_1", "X_2"],
             ("X", "X_1", "X_1", "X", "X"): ["X", "X_1", "X_1_1", "X_2", "X_3"], ("Y_2", "Y", "Y", "Y", "Y"): ["Y_2", "Y", "Y_1", "Y_3", "Y_4"]}
    rows = [(100 * c + i, f"c{c}{n}") for c, names in enumerate(cases) for i, n in enumerate(names)]
    got = {r["o"]: r["file_name"] for r in unique_names(spark.createDataFrame(rows, "o int, n string"), "n", "o").collect()}
    want = {100 * c + i: f"c{c}{n}" for c, names in enumerate(cases.values()) for i, n in enumerate(names)}
    assert got == want
