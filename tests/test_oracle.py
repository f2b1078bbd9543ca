"""Registered queries against their DuckDB twins on the smallest test tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from ladle.plans.views import TABLES

SAMPLE = ["validate_docs", "eval_summary", "json_route", "chat_render", "supervised_ratio", "pair_anti",
          "style_distribution", "split_exact", "running_eta", "unique_name", "score_axes", "judge_normalize",
          "eval_report", "human_time", "outcome_counts_pair"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.md5(repr(tuple(_norm(r[i]) for i in order)).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    library = E.load_library()
    assert set(library) <= set(E.queries())
    assert all(sql for _, sql in library.values()) and set(library) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", SAMPLE)
def test_matches_duckdb(spark, sf_dir, con, key):
    df = E.queries()[key](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)


def test_entry(spark):
    out = E.entry(spark)
    assert out.columns == ["total_samples", "valid_count", "invalid_count", "valid_percentage"]
    assert out.count() == 1


def test_entry_module_imports_without_spark():
    import subprocess
    import sys
    code = ("import __spark_entry__ as E; from pyspark import SparkContext; "
            "q = E.queries(); s = E.oracle_sql(); assert SparkContext._active_spark_context is None; n = len(E.load_library()); print(len(q) >= n, len(s) >= n)")
    out = subprocess.run([sys.executable, "-c", code], cwd=E.__file__.rsplit("/", 1)[0], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split() == ["True", "True"]
