"""The report document can be written in gzip parts, and eval_document does so."""

import gzip
import json
import os
import tempfile

from pyspark.sql import functions as F

from ladle.plans import q_score
from ladle.sources import io as IO


def test_packed_parts_one_after_the_other_are_the_document(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="ladle-packed-"), "r")
    samples = spark.range(500).selectExpr("id AS sample_id", "repeat('text \\n\"é', 50) AS text").repartition(5)
    run = spark.createDataFrame([("m",)], "model_name string")
    IO.write_report_document(d, run, samples, samples.agg(F.count(F.lit(1)).alias("n")), packed=True)
    parts = sorted(p for p in os.listdir(d) if p.startswith("part-"))
    assert parts and all(p.endswith(".gz") for p in parts)
    whole = b"".join(open(os.path.join(d, p), "rb").read() for p in parts)
    doc = json.loads(gzip.decompress(whole))
    assert [s["sample_id"] for s in doc["samples"]] == list(range(500)) and doc["summary"] == {"n": 500}
    assert len(whole) * 10 < len(gzip.decompress(whole))
    assert IO.read_report_document(spark, d, "sample_id bigint, text string").exceptAll(samples).count() == 0


def test_eval_document_packs_its_text(spark, sf_dir, monkeypatch):
    folders = []

    def spy(spark, name):
        folders.append(real(spark, name))
        return folders[-1]
    real = q_score.scratch_dir
    monkeypatch.setattr(q_score, "scratch_dir", spy)
    q_score.eval_document(spark, sf_dir)
    at = [f.removeprefix("file:") for f in folders if "report-document" in f]
    assert all(p.endswith(".gz") for p in os.listdir(at[0]) if p.startswith("part-"))
