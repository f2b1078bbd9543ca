"""Whole-file streams: tasks list the files, the stream's own log holds lists of them only."""

import os
import tempfile

from ladle.streaming import ingest as ST


def test_no_name_of_a_file_reaches_the_streams_log(spark):
    d = tempfile.mkdtemp(prefix="ladle-lists-")
    src, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))
    os.makedirs(os.path.join(src, "p=1"))

    def drop(name, text):
        with open(os.path.join(src, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    for i in range(25):
        drop(f"doc {i} é%.txt", f"text {i}")
    for name, text in (("empty.txt", ""), ("_hidden.txt", "x"), (".dot.txt", "x"), ("other.md", "x"), ("p=1/below.txt", "t")):
        drop(name, text)
    first = ST.ingest_stream(spark, src, out, ck, lambda d: d, fmt="files", files_per_trigger=10)
    want = {f"doc {i} é%": f"text {i}" for i in range(25)} | {"below": "t"}
    assert first == 3 and {r["rid"]: r["text"] for r in spark.read.parquet(out).collect()} == want
    log = os.path.join(ck, "sources", "0")
    for name in os.listdir(log):
        with open(os.path.join(log, name), encoding="utf-8", errors="replace") as fh:
            assert ".txt" not in fh.read()
    drop("p=1/doc 3 é%.txt", "again")  # a stem that was there
    drop("new.txt", "n")
    ST.ingest_stream(spark, src, out, ck, lambda d: d, fmt="files", files_per_trigger=10)
    assert {r["rid"]: r["text"] for r in spark.read.parquet(out).collect()} == want | {"new": "n"}
    assert spark.read.parquet(out).count() == 27
    assert ST.ingest_stream(spark, src, out, ck, lambda d: d, fmt="files", files_per_trigger=10) in (0, 4)  # nothing new
