"""Unique names (G4) against a plain walk over the rows in order."""

import random

from pyspark.sql import functions as F

from ladle.operators.names import BLOCK, unique_names


def walked(names):
    taken, counter, out = set(), {}, []
    for name in names:
        made, k = name, counter.get(name, 0)
        while made in taken:
            k += 1
            made = f"{name}_{k}"
        counter[name] = k
        taken.add(made)
        out.append(made)
    return out


def named(spark, names, parts=3):
    df = spark.createDataFrame(list(enumerate(names)), "i long, n string").repartition(parts)
    return [r["file_name"] for r in unique_names(df, "n", "i").orderBy("i").collect()]


def test_numbers_met_before_and_after(spark):
    cases = [["X_1", "X", "X"], ["X", "X", "X_1"], ["X", "X", "X_1", "X_1", "X"], ["X", "X_2", "X", "X", "X_1", "X_1_1", "X"], ["X_1", "X_1"], ["A"]]
    names = [n.replace("X", f"X{i}") for i, case in enumerate(cases) for n in case]  # families do not meet
    got = named(spark, names)
    assert got == walked(names)
    assert got[:6] == ["X0_1", "X0", "X0_2", "X1", "X1_1", "X1_1_1"]


def test_many_families_and_depths(spark):
    rng = random.Random(6)
    names = []
    for f in range(60):
        some = [f"f{f}"] * rng.randrange(1, 12) + [f"f{f}" + "".join(f"_{rng.randrange(1, 6)}" for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(14))]
        names += some
    names += ["z_0", "z_01", "z", "z", "z", "_1", "_1", "a_", "a_", "q_999999999999999999999", "q", "q"]
    rng.shuffle(names)
    assert named(spark, names, 7) == walked(names)


def test_hot_family_with_thousands_of_numbers(spark):
    rng = random.Random(7)
    names = ["hot"] * 6000 + [f"hot_{k}" for k in rng.sample(range(1, 9000), 3 * BLOCK)] + [f"cold{k}" for k in range(3000)]
    rng.shuffle(names)
    assert named(spark, names, 8) == walked(names)


def test_hot_name_is_spread_without_python(spark):
    rows = spark.range(30_000).select(F.col("id").alias("i"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("hot_"), F.col("id"))).alias("n"))
    out = unique_names(rows, "n", "i")
    assert out.select("file_name").distinct().count() == 30_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "InPandas" not in plan
    parts = out.where("n = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 12_000
