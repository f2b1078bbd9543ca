import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # names that the operators use themselves
                       T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("words", T.StringType()),
                       T.StructField("row", T.StringType()), T.StructField("copy", T.StringType()), T.StructField("label", T.StringType())])


def edge_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows and copies of one text."""
    rng = random.Random(4)
    vocab = [a + b for a in "ba ko lu mi ster vo en da".split() for b in "ra ti no kel mu se".split()]
    base = [" ".join(rng.choice(vocab) for _ in range(80)) for _ in range(6)]
    near = base[0].split()
    near[40] = "changed"
    texts = [*base, base[0], base[0].upper(), " ".join(near), None, "", "  \n\t ", "one two", "One  two", "###", "1234 5678",
             " ".join(rng.choice(vocab) for _ in range(30_000)), "x" * 50_000, "line a\nline a\nline a\n" * 20,
             "Licensed under the Apache License, Version 2.0.\nCC-BY; gnu GENERAL public-license", "MIT license", "mit  License! mit license",
             "a b c a b c a b c " * 12, "éÀ œ ß ñandú " * 30, "İstanbul K  x", "%%% ### && " * 40]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, None if i % 7 == 0 else len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, base[1], "en", "src0", 1), (None, None, None, None, None), rows[2], rows[2], (999, None, None, "src0", None)]
    rows += [(100 + i, base[3], "fr", "src0", 5) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame([r + ("x",) * 6 for r in edge_rows()], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs001(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts001(docs001):
    return {r["doc_id"]: r["text"] for r in docs001.collect()}
