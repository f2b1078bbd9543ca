"""Splits, positions and skew-safe windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ladle.operators import split as SP
from ladle.operators.ids import global_rank, group_rank, group_running_sum
from ladle.operators.names import unique_names


def test_split_sizes(spark):
    for n, train in [(0, 0), (1, 0), (10, 8), (11, 8)]:
        df = spark.range(n).withColumn("k", F.col("id").cast("string"))
        if n == 0:
            assert SP.split_exact(df, "k", 0.8, 42).count() == 0
            continue
        out = SP.split_exact(df, "k", 0.8, 42)
        assert out.filter("split = 'train'").count() == train
        assert out.count() == n


def test_split_is_partition_and_stable(spark):
    df = spark.range(500).withColumn("k", F.concat(F.lit("doc_"), F.col("id").cast("string")))
    a = SP.split_exact(df, "k", 0.8, 7)
    b = SP.split_exact(df.repartition(13), "k", 0.8, 7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    checks = {r.metric: r.value for r in SP.check_split(a.filter("split = 'train'").select("k"),
                                                         a.filter("split = 'test'").select("k"), df.select("k")).collect()}
    assert checks["missing"] == 0 and checks["extra"] == 0 and checks["overlap"] == 0 and checks["n_train"] == 400


def test_split_check_counts_what_is_wrong(spark):
    def frame(keys):
        return spark.createDataFrame([(k,) for k in keys], "k string")
    rows = SP.check_split(frame("aabx"), frame("bc"), frame("aaabcd")).collect()
    assert {r.metric: r.value for r in rows} == {"n_all": 6, "n_train": 4, "n_test": 2, "missing": 2, "extra": 2, "overlap": 1}


def test_holdout_ceil(spark):
    df = spark.range(21).withColumn("k", F.col("id").cast("string"))
    assert SP.holdout(df, "k", 0.05, 42).filter("split = 'test'").count() == 2


def test_global_rank_equals_window(spark):
    df = spark.range(3000).withColumn("o", (F.col("id") * 7919) % 3001)
    got = global_rank(df, ["o", "id"], name="pos", total="n")
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("o", "id")))
    assert got.select("id", "pos").exceptAll(want.select("id", "pos")).count() == 0
    assert got.select(F.max("n")).first()[0] == 3000


def test_group_rank_with_hot_key(spark):
    # one key holds a third of all rows
    df = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")))
    got = group_rank(df, ["g"], ["id"], name="r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    assert got.select("id", "r").exceptAll(want.select("id", "r")).count() == 0


def test_group_running_sum(spark):
    df = spark.range(2000).withColumn("g", F.col("id") % 3).withColumn("v", F.col("id") % 17)
    got = group_running_sum(df, ["g"], ["id"], "v", rank="r", before="b")
    w = Window.partitionBy("g").orderBy("id")
    want = df.withColumn("r", F.row_number().over(w)).withColumn(
        "b", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert got.select("id", "r", "b").exceptAll(want.select("id", "r", "b")).count() == 0


def test_unique_names_with_natural_collision(spark):
    rows = [(1, "X"), (2, "X"), (3, "X_1"), (4, "X"), (5, "a/b")]
    df = spark.createDataFrame(rows, "o long, name string")
    out = {r.o: r.file_name for r in unique_names(df, "name", "o").collect()}
    assert len(set(out.values())) == len(out)
    assert out[1] == "X" and out[5] == "a-b"


def test_batches(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    b = SP.with_batch(df, ["k"], 48)
    rows = {r.k: r for r in b.collect()}
    assert rows[0].batch_num == 1 and rows[48].batch_num == 2 and rows[99].batch_num == 3
    assert rows[99].batch_start == 97 and rows[99].batch_end == 100
    first = SP.first_n_per_batch(b, 2, 48)
    assert sorted(r.k for r in first.collect()) == [0, 1, 48, 49, 96, 97]


def test_hash_rank_equals_window(spark):
    from ladle.operators.ids import hash_rank
    from ladle.operators.split import seeded_hash
    df = spark.range(5000).withColumn("k", F.concat(F.lit("k"), F.col("id").cast("string")))
    df = df.withColumn("h", seeded_hash(F.col("k"), 3))
    got = hash_rank(df.repartition(9), "h", "k", name="pos", total="n")
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("h", "k")))
    assert got.select("k", "pos").exceptAll(want.select("k", "pos")).count() == 0
    assert got.select(F.max("n")).first()[0] == 5000


def test_slice_rows_both_paths(spark):
    df = spark.range(50).select((49 - F.col("id")).alias("o"))
    top = [r.o for r in SP.slice_rows(df, ["o"], skip=3, limit=4).collect()]
    assert top == [3, 4, 5, 6]
    rest = sorted(r.o for r in SP.slice_rows(df, ["o"], skip=45).collect())
    assert rest == [45, 46, 47, 48, 49]
    assert SP.slice_rows(df, ["o"]).count() == 50
    assert [r.o for r in SP.limit_inputs(df, ["o"], 2).collect()] == [0, 1]


def test_group_helpers_across_many_partitions(spark):
    # "hot" spans many range partitions entirely; NULL is a group of its own; values go negative
    df = (spark.range(4000)
          .withColumn("g", F.when(F.col("id") % 3 == 0, F.lit("hot"))
                      .when(F.col("id") % 11 == 0, F.lit(None).cast("string"))
                      .otherwise((F.col("id") % 7).cast("string")))
          .withColumn("v", (F.col("id") % 13) - 6))
    w = Window.partitionBy("g").orderBy("id")
    want = (df.withColumn("r", F.row_number().over(w))
              .withColumn("b", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    got_r = group_rank(df, ["g"], ["id"], name="r", partitions=16)
    assert got_r.select("id", "r").exceptAll(want.select("id", "r")).count() == 0
    got_s = group_running_sum(df, ["g"], ["id"], "v", rank="r", before="b", partitions=16, size="n")
    want = want.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    assert got_s.count() == 4000
    assert got_s.select("id", "r", "b", "n").exceptAll(want.select("id", "r", "b", "n")).count() == 0
