"""Sources, sinks and streaming."""

import os
import tempfile

from pyspark.sql import functions as F

from ladle.sources import io as IO
from ladle.streaming import ingest as ST


def test_csv_quotes_newlines_latin1(spark):
    d = tempfile.mkdtemp(prefix="ladle-csv-")
    utf8 = os.path.join(d, "u")
    os.makedirs(utf8)
    with open(os.path.join(utf8, "r.csv"), "w", encoding="utf-8") as fh:
        fh.write('name,group\n"Say ""hi""","two\nlines"\ncrème,x\n')
    rows = IO.read_csv(spark, utf8, columns=["name", "group"]).collect()
    assert [tuple(r) for r in rows] == [('Say "hi"', "two\nlines"), ("crème", "x")]
    lat = os.path.join(d, "l")
    os.makedirs(lat)
    with open(os.path.join(lat, "r.csv"), "wb") as fh:
        fh.write("name,group\ncrème,brûlée\n".encode("latin-1"))
    assert len(IO.badly_encoded(spark, lat)) == 1
    assert [tuple(r) for r in IO.read_csv(spark, lat, columns=["name", "group"]).collect()] == [("crème", "brûlée")]


def test_text_and_json_dirs(spark):
    d = tempfile.mkdtemp(prefix="ladle-dir-")
    for name, body in [("a b+c.txt", "x\r\ny\rz"), ("v1.2.txt", "v"), ("skip.md", "no")]:
        with open(os.path.join(d, name), "w", encoding="utf-8", newline="") as fh:
            fh.write(body)
    got = {r.stem: r.text for r in IO.read_text_dir(spark, d).collect()}
    assert got == {"a b+c": "x\ny\nz", "v1.2": "v"}
    j = tempfile.mkdtemp(prefix="ladle-json-")
    for name, body in [("r1.json", '{"recipe": {"b": 1, "a": 2}, "reasoning": "why"}'),
                       ("r2.json", '{"recipe": {}}'), ("r3.json", '{"recipe": {"z": 1}, "reasoning": null}')]:
        with open(os.path.join(j, name), "w", encoding="utf-8") as fh:
            fh.write(body)
    got = {r.stem: (r.recipe_json, r.reasoning) for r in IO.read_json_dir(spark, j).collect()}
    assert got == {"r1": ('{"b":1,"a":2}', "why"), "r2": ("{}", ""), "r3": ('{"z":1}', None)}


def test_whole_files_are_opened_without_the_text_source(spark):
    import gzip
    d = tempfile.mkdtemp(prefix="ladle-whole-")
    bodies = {"plain é.txt": "a\r\nb\rc\n".encode(), "bad.txt": b"caf\xe9 \xff\x00 \xed\xa0\x80 \xf0\x9f", "bom.txt": "\ufeffx\n\n".encode(), "empty.txt": b""}
    for name, body in bodies.items():
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(body)
    with gzip.open(os.path.join(d, "packed.gz"), "wb") as fh:
        fh.write(b"in\r\nside")

    def got(df):
        return sorted((r["stem"], bytes(r["t"])) for r in df.select("stem", F.col("text").cast("binary").alias("t")).collect())
    files = IO.read_text_dir(spark, d)
    old = spark.read.text(d, wholetext=True, pathGlobFilter="*.txt")
    assert got(files) == got(old.select(IO.path_stem(IO.file_name()).alias("stem"), IO.normalise_newlines("value").alias("text")))
    assert "FileScan binaryFile" in files._jdf.queryExecution().executedPlan().toString()
    assert got(IO.read_text_dir(spark, d, "*.gz")) == [("packed", b"in\nside")]  # unpacked, as before


def test_path_stem(spark):
    df = spark.createDataFrame([("a.txt",), (".bashrc",), ("x.tar.gz",), ("noext",), ("dot.",)], "f string")
    assert [r.s for r in df.select(IO.path_stem("f").alias("s")).collect()] == ["a", ".bashrc", "x.tar", "noext", "dot."]


def test_records_roundtrip_keeps_nulls_and_text(spark):
    d = tempfile.mkdtemp(prefix="ladle-rec-")
    df = spark.createDataFrame([("s1", '{"b":1,"a":"é"}', None), ("s2", "{}", 'q"uote\n')], "stem string, recipe_json string, reasoning string")
    IO.write_records(df, os.path.join(d, "out"))
    back = {r.stem: (r.recipe_json, r.reasoning) for r in IO.read_records(spark, os.path.join(d, "out")).collect()}
    assert back == {"s1": ('{"b":1,"a":"é"}', None), "s2": ("{}", 'q"uote\n')}


def test_stream_exactly_once(spark):
    d = tempfile.mkdtemp(prefix="ladle-stream-")
    src, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))
    spark.createDataFrame([(str(i), f"T{i}\n- item {i}") for i in range(20)], "rid string, text string").repartition(3).write.json(src)

    def tr(df):
        return df.select("rid", F.length("text").alias("n"))
    batches = ST.ingest_stream(spark, src, out, ck, tr, files_per_trigger=1)
    assert spark.read.parquet(out).count() == 20 and batches >= 3
    ST.ingest_stream(spark, src, out, ck, tr)          # nothing new: no new rows
    assert spark.read.parquet(out).count() == 20
    spark.createDataFrame([("99", "late")], "rid string, text string").write.mode("append").json(src)
    ST.ingest_stream(spark, src, out, ck, tr)
    assert spark.read.parquet(out).count() == 21


def test_require_non_empty(spark):
    import pytest
    with pytest.raises(ValueError):
        IO.require_non_empty(spark.range(0), "rows")


def test_report_tables(spark, sf_dir):
    import __spark_entry__ as E
    d = tempfile.mkdtemp(prefix="ladle-report-")
    samples = E.queries()["attach_scores"](spark, sf_dir)
    summary = E.queries()["eval_report"](spark, sf_dir)
    run = summary.select("model_name", "batch_size", "vibes_samples_per_batch", "vibes_model")
    IO.write_report(os.path.join(d, "r"), run, samples, summary.drop("model_name", "vibes_model"))
    r, s, m = IO.read_report(spark, os.path.join(d, "r"))
    assert r.count() == 1 and m.count() == 1 and s.count() == samples.count()


def test_from_rows(spark):
    df = IO.from_rows(spark, [{"stem": "a", "messages": [{"role": "user", "content": "hi"}]}])
    assert df.first().messages[0].content == "hi" and df.schema["stem"].dataType.simpleString() == "string"


def test_csv_columns_by_header_name(spark):
    d = tempfile.mkdtemp(prefix="ladle-csvh-")
    with open(os.path.join(d, "r.csv"), "w", encoding="utf-8") as fh:
        fh.write("group,name\ng1,n1\n")
    row = IO.read_csv(spark, d, columns=["name", "group"]).first()
    assert (row.name, row.group) == ("n1", "g1")


def test_jsonl_keeps_nulls(spark):
    d = tempfile.mkdtemp(prefix="ladle-jsonl-")
    df = IO.from_rows(spark, [{"stem": "a", "messages": [{"role": "assistant", "content": None}]}])
    IO.write_jsonl(df, os.path.join(d, "o"))
    text = spark.read.text(os.path.join(d, "o")).first().value
    assert '"content":null' in text


def test_report_is_one_document(spark):
    import glob
    import json
    d = tempfile.mkdtemp(prefix="ladle-reportdoc-")
    run = spark.createDataFrame([("m", None)], "model_name string, note string")
    samples = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("sample_id"), F.concat(F.lit('q"\n{],'), F.col("id")).alias("text"),
                                       F.when(F.col("id") % 3 == 0, F.struct(F.array(F.lit("e")).alias("errors"))).alias("nested"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        IO.write_report_document(os.path.join(d, "r"), run, samples, samples.agg(F.count(F.lit(1)).alias("n")))
        IO.write_report_document(os.path.join(d, "none"), run, samples.limit(0), samples.limit(0).agg(F.count(F.lit(1)).alias("n")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def whole(folder):
        parts = sorted(glob.glob(os.path.join(d, folder, "part-*")))
        return len([p for p in parts if os.path.getsize(p)]), json.loads("".join(open(p, encoding="utf-8").read() for p in parts))
    parts, doc = whole("r")
    want = sorted(((r["sample_id"], r["text"], r["nested"]) for r in samples.collect()), key=lambda r: r[0])
    assert parts > 1 and doc["metadata"] == {"model_name": "m", "note": None} and doc["summary"] == {"n": 5000}
    assert [(s["sample_id"], s["text"], s["nested"]) for s in doc["samples"]] == [(a, b, c and c.asDict()) for a, b, c in want]
    assert whole("none")[1] == {"metadata": {"model_name": "m", "note": None}, "samples": [], "summary": {"n": 0}}
    schema = "sample_id bigint, text string, nested struct<errors:array<string>>"
    assert IO.read_report_document(spark, os.path.join(d, "r"), schema).exceptAll(samples).count() == 0


def test_record_files_of_failed_tasks_are_not_left(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="ladle-files-")
    rows = spark.createDataFrame([(f"n{i} é+", None if i == 3 else f"text {i}\r\n") for i in range(40)], "n string, t string").repartition(4)
    assert IO.write_files(rows, os.path.join(d, "a"), "n", "t", ".txt") == 40
    assert sorted(os.listdir(os.path.join(d, "a"))) == sorted(f"n{i} é+.txt" for i in range(40))
    assert {r["stem"]: r["text"] for r in IO.read_text_dir(spark, os.path.join(d, "a")).collect()} == {
        f"n{i} é+": f"text {i}\n" for i in range(40) if i != 3}  # Spark's file sources pass over files of no bytes
    broken = rows.coalesce(1).withColumn("n", F.when(F.col("n") == "n20 é+", F.raise_error(F.lit("no"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="no"):
        IO.write_files(broken, "file://" + os.path.join(d, "b"), "n", "t", ".txt")
    assert os.listdir(os.path.join(d, "b")) == []


def _drop(folder, names, text="T"):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(os.path.join(folder, n), "w", encoding="utf-8") as fh:
            fh.write(f"{text} {n}")


def test_stream_takes_each_document_once(spark):
    d = tempfile.mkdtemp(prefix="ladle-once-")
    src, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))

    def tr(df):
        return df.select("rid", F.length("text").alias("n"))

    def stems():
        return sorted(r["rid"] for r in spark.read.parquet(out).collect())
    # the same stem in two folders of one run, and again, in a new file with another text, in a later run
    _drop(os.path.join(src, "p=1"), ["a.txt", "b.txt"])
    _drop(os.path.join(src, "p=2"), ["a.txt", "c.txt"])
    ST.ingest_stream(spark, src, out, ck, tr, fmt="files", files_per_trigger=1)
    assert stems() == ["a", "b", "c"]
    _drop(os.path.join(src, "p=3"), ["b.txt", "d.txt"], text="another text")
    ST.ingest_stream(spark, src, out, ck, tr, fmt="files")
    assert stems() == ["a", "b", "c", "d"]


def test_counts_of_a_replayed_batch_do_not_count_twice(spark):
    d = tempfile.mkdtemp(prefix="ladle-replay-")
    src, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))

    def tr(df):
        return df.select("rid", F.when(F.length("text") > 6, "long").otherwise("short").alias("outcome"))

    def counts():
        return {r["outcome"]: r["n"] for r in ST.read_counts(spark, out).collect()}
    _drop(src, ["a.txt", "bb.txt", "c.txt"])
    ST.stream_counts(spark, src, out, ck, tr, fmt="files", files_per_trigger=1)
    want = counts()
    assert sum(want.values()) == 3
    commits = [int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit()]
    for f in (f"{max(commits)}", f".{max(commits)}.crc"):  # as if the driver had died before the commit: the last batch runs again
        os.remove(os.path.join(ck, "commits", f))
    ST.stream_counts(spark, src, out, ck, tr, fmt="files", files_per_trigger=1)
    assert counts() == want
    # re-delivered documents and new ones
    _drop(os.path.join(src, "p=2"), ["a.txt", "new.txt"])
    ST.stream_counts(spark, src, out, ck, tr, fmt="files")
    assert sum(counts().values()) == 4
    # only the new batch was written: the folders of the earlier ones are as they were
    batches = sorted(f for f in os.listdir(out) if f.startswith("batch_id="))
    assert len(batches) >= 4


def test_counts_merge_is_by_batch(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="ladle-merge-"), "o")
    batch = spark.createDataFrame([("ok", 1), ("ok", 2), ("error", 3)], "outcome string, x int")
    for batch_id in (0, 1, 1, 0):
        ST.add_batch(batch, batch_id, out, "outcome")
    assert {r["outcome"]: r["n"] for r in ST.read_counts(spark, out).collect()} == {"ok": 4, "error": 2}
