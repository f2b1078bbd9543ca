"""Splittable CSV with newlines in cells: rows as Python's csv reader gives them, whatever the splits."""

import csv
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ladle.sources import io as IO
from ladle.sources.csv_records import csv_records, splits

CELLS = ["a", "", "x y", '"', '""', 'q"u', "line\nbreak", "a,b", '"\n"', " s ", "\n\n", "é", '"quoted"', ',"', '5" pipe', "z\r\ny", "\n,\n"]
# unquoted cells with quotes in them, text after a closing quote, an empty line, a record without a line end
LOOSE = 'id,a,b\nx,5" pipe,2" cut\ny,"m\nn",o"p"\n\nz,"t ""u""\n",v'


@pytest.fixture(scope="module")
def folder():
    rng, d = random.Random(2), tempfile.mkdtemp(prefix="ladle-csvr-")
    for k in range(4):
        with open(os.path.join(d, f"f{k}.csv"), "w", newline="", encoding="utf-8") as fh:
            w = csv.writer(fh, lineterminator="\r\n" if k == 1 else "\n")
            w.writerow(["id", "a", "b"])
            for n in range(60):
                w.writerow([f"{k}-{n}", rng.choice(CELLS), "".join(rng.choice(CELLS) for _ in range(rng.randrange(4)))])
    with open(os.path.join(d, "f9.csv"), "w", newline="", encoding="utf-8") as fh:
        fh.write(LOOSE)
    return d


def python_rows(folder):
    rows = []
    for p in sorted(os.listdir(folder)):
        with open(os.path.join(folder, p), newline="", encoding="utf-8") as fh:
            rows += [tuple(r) for r in list(csv.reader(fh))[1:] if r]
    return sorted(rows)


@pytest.fixture
def split_size(spark):
    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield put
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", ["40b", "200b", "128m"])
def test_rows_do_not_depend_on_splits(spark, folder, split_size, size):
    split_size(size)
    got = sorted(tuple(r) for r in IO.read_csv(spark, folder, columns=["id", "a", "b"]).collect())
    assert got == python_rows(folder)
    assert csv_records(spark, folder).where("first").count() == 5


def test_one_large_file_is_read_by_many_tasks(spark, split_size):
    d = tempfile.mkdtemp(prefix="ladle-csvl-")
    with open(os.path.join(d, "one.csv"), "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(["id", "a"])
        for n in range(3000):
            w.writerow([n, "first line\nsecond, line\n\n" * (1 + n % 40)])
    split_size("64k")
    out = IO.read_csv(spark, d, columns=["id", "a"])
    tasks = out.where("id <> ''").select(F.spark_partition_id().alias("p"), "id").groupBy("p").count()
    assert tasks.count() >= 8 and tasks.agg(F.max("count")).first()[0] < 1000
    assert out.agg(F.countDistinct("id"), F.sum(F.length("a"))).first() == (3000, sum(25 * (1 + n % 40) for n in range(3000)))
    assert splits(spark, d).where("inside").count() >= 8  # most splits start inside a cell


def test_cell_longer_than_many_splits(spark, split_size):
    d = tempfile.mkdtemp(prefix="ladle-csvc-")
    with open(os.path.join(d, "one.csv"), "w", newline="", encoding="utf-8") as fh:
        csv.writer(fh).writerows([["id", "a"], ["1", "x\n" * 2000], ["2", "y"]])
    split_size("100b")
    assert sorted(tuple(r) for r in IO.read_csv(spark, d, columns=["id", "a"]).collect()) == [("1", "x\n" * 2000), ("2", "y")]


def test_encodings_file_by_file(spark, split_size):
    d = tempfile.mkdtemp(prefix="ladle-csve-")
    for name, enc in (("u.csv", "utf-8"), ("l.csv", "latin-1")):
        with open(os.path.join(d, name), "w", newline="", encoding=enc) as fh:
            csv.writer(fh).writerows([["name", "group"], *[[f"crème {enc} {k}", "brûlée\nü"] for k in range(20)]])
    split_size("64b")
    want = sorted((f"crème {enc} {k}", "brûlée\nü") for enc in ("utf-8", "latin-1") for k in range(20))
    assert sorted(tuple(r) for r in IO.read_csv(spark, d, columns=["name", "group"]).collect()) == want


def test_short_long_and_empty_rows(spark):
    d = tempfile.mkdtemp(prefix="ladle-csvs-")
    with open(os.path.join(d, "r.csv"), "w", encoding="utf-8") as fh:
        fh.write('a,b,c\n1\n2,,\n3,"",x\n4,5,6,7\n\n')
    rows = {r["a"]: (r["b"], r["c"], r["_row_error"] is not None) for r in IO.read_csv(spark, d, columns=["a", "b", "c"], row_error=True).collect()}
    assert rows == {"1": (None, None, True), "2": ("", "", False), "3": ("", "x", False), "4": ("5", "6", True)}
    plain = IO.read_csv(spark, d, columns=["a", "b", "c"], row_error=True, multi_line=False)
    assert {r["a"]: (r["b"], r["c"], r["_row_error"] is not None) for r in plain.collect()} == rows


def test_header_only_and_no_rows(spark):
    d = tempfile.mkdtemp(prefix="ladle-csvn-")
    with open(os.path.join(d, "r.csv"), "w", encoding="utf-8") as fh:
        fh.write("a,b\n")
    assert IO.read_csv(spark, d, columns=["a", "b"]).count() == 0
