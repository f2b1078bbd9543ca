"""Token repair by runs, and the rung that closes brackets, against the plain rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ladle.functions import jsondoc as J
from ladle.functions import jsonrepair as JR

PARTS = ['{', '}', '[', ']', ',', ':', '"a"', "'b'", '"it\'s"', '"say "x" y"', "'d \"q\" e'", '"t\\"u"', "'v\\'w'", '"line\nbreak"', '""', "''", '“c”',
         'key', 'None', 'true', '1', '-2.5', ' ', '\n', '// note\n', '/* "x": */', '"a":"b"', '"a":', "'a':", '"a","b"', "'a','b'", '"', "'", '\\', '”', '[]', '{}', '",', "x'y"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(6000)]


def test_runs_change_no_result(spark, texts, monkeypatch):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = dict(df.select("i", JR.repair_tokens(F.col("v"))).collect())
    monkeypatch.setattr(JR, "TOKEN_RE", JR.SINGLE_TOKEN_RE)
    want = dict(df.select("i", JR.repair_tokens(F.col("v"))).collect())
    assert [(texts[i], got[i], want[i]) for i in got if got[i] != want[i]] == []


@pytest.mark.parametrize("quote", ['"', "'"])
def test_sound_stretches_are_one_token(spark, quote):
    text = '{"name":"x","steps":[' + ",".join('{"@type":"Step","text":"Pick part %d"}' % i for i in range(500)) + ']}'
    df = spark.createDataFrame([(text.replace('"', quote),)], "v string")
    n, out = df.select(F.size(F.regexp_extract_all("v", F.lit(JR.TOKEN_RE), F.lit(0))), JR.repair_tokens(F.col("v"))).first()
    assert n <= 2 and out == text


def _closed(text):
    """The rung's rule, read from the right one bracket at a time."""
    if len(re.sub(r'[^"]', "", re.sub(r"(?s)\\.", "", text))) % 2:
        tail = len(text) - len(text.rstrip("\\"))
        text = (text[:-1] if tail % 2 else text) + '"'
    waiting, closers = 0, ""
    for b in reversed(re.findall(r"[\[\]{}]", re.sub(r'(?s)"(?:[^"\\]|\\.)*"', "", text))):
        if b in "]}":
            waiting += 1
        elif waiting:
            waiting -= 1
        else:
            closers += "}" if b == "{" else "]"
    return None if waiting else re.sub(r'(?s)("(?:[^"\\]|\\.)*")|,(\s*[}\]])', lambda m: (m[1] or "") + (m[2] or ""), text + closers)


def test_brackets_closed_as_by_the_plain_pass(spark, texts):
    rng = random.Random(7)
    deep = ["".join(rng.choice('{[{[}]]},"') for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    cases = texts + deep + ["{" * 500 + "[" * 300 + "]" * 250]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, v string")
    got = dict(df.select("i", J._close_open(F.col("v"))).collect())
    assert [(c, got[i], _closed(c)) for i, c in enumerate(cases) if got[i] != _closed(c)] == []


def test_ladder_is_the_first_rung_that_parses(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    parsed = J.parse_tolerant(df, "v").select("i", "outcome", "json_text")
    got = {r["i"]: tuple(r)[1:] for r in parsed.collect()}
    rungs = df.select("i", *[F.when(J.parse_strict(c).isNotNull(), c).alias(f"c{k}") for k, c in enumerate(J.candidates("v"))])
    want = {}
    for r in rungs.collect():
        k = next((k for k in range(7) if r[f"c{k}"] is not None), None)
        want[r["i"]] = ("rejected", None) if k is None else ("ok" if k == 0 else "repaired", r[f"c{k}"])
    assert [(texts[i], got[i], want[i]) for i in got if got[i] != want[i]] == []
