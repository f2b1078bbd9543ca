"""Unique file names (G4): the first holder keeps the name, later ones take the first free ``_1``, ``_2``...

A row that finds its name taken searches ``name_1``, ``name_2``, ... and the numbers it passes are those that
some record carried by itself before (``X_1`` among records named ``X``).  Which numbers are passed
follows from the names alone, without walking rows:

* ``before`` is the number of rows named X that stand before the first row named X_k.  The k-th
  number is reached by X's searcher k - c, c being the numbers passed so far; it is passed if that
  searcher comes after X_k's first row.  This is a running pass over the numbered names of X in order
  of k, on a table with one row for each distinct numbered name.
* If the number is not passed, the name was made before its first own record came, so all records of
  that name search (``X, X, X_1`` gives ``X, X_1, X_1_1``).  So names go by depth: X, X_1, X_1_1, ...
* The j-th searcher's number is j plus the passed numbers up to it: a gap rank, which is a running
  sum over rows and passed numbers in order.

Rows are ranked by ``group_rank`` and ``group_running_sum``, which spread a name held by a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions import text as T
from ladle.operators.ids import group_rank, group_running_sum
from ladle.session import scratch_dir

NUMBERED_RE = r"^(.*)_([1-9][0-9]{0,17})$"
#: numbers that one inner pass takes, so that lists of results stay short while they grow
BLOCK = 1024


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _passed(numbers: Column) -> Column:
    """For (k, searchers before k's first row), in order of k: whether each number is passed."""
    def one(acc: Column, x: Column) -> Column:
        over = x["k"] - acc["c"] > x["searchers"]
        return F.struct((acc["c"] + F.when(over, 1).otherwise(0)).cast("bigint").alias("c"), F.concat(acc["out"], F.array(over)).alias("out"))

    def block(acc: Column, b: Column) -> Column:
        start = F.struct(acc["c"].alias("c"), F.array().cast("array<boolean>").alias("out"))
        inner = F.aggregate(F.slice(numbers, b * BLOCK + 1, BLOCK), start, one)
        # a list of one, so that the inner pass is made once
        return F.get(F.transform(F.array(inner), lambda r: F.struct(r["c"].alias("c"), F.concat(acc["out"], F.array(r["out"])).alias("out"))), 0)
    start = F.struct(F.lit(0).cast("bigint").alias("c"), F.array().cast("array<array<boolean>>").alias("out"))
    blocks = F.sequence(F.lit(0), F.ceil(F.size(numbers) / BLOCK).cast("int") - 1)
    return F.flatten(F.aggregate(blocks, start, block)["out"])


def _numbers(base: DataFrame, names: DataFrame, order_col: str) -> DataFrame:
    """(name, parent, k, before): every numbered name beside its unnumbered one, if both occur, with the
    parent's rows before the name's first row."""
    split = [F.regexp_extract("_safe", NUMBERED_RE, i) for i in (1, 2)]
    found = names.select(F.col("_safe").alias("name"), split[0].alias("parent"), split[1].alias("k"), "first").where("k <> ''")
    found = found.withColumn("k", F.col("k").cast("bigint")).join(names.select(F.col("_safe").alias("parent")), "parent", "left_semi")
    rows = base.join(found.select(F.col("parent").alias("_safe")).distinct(), "_safe", "left_semi")
    none = F.lit(None).cast("string")
    both = rows.select(F.col("_safe").alias("parent"), F.col(order_col).alias("at"), F.lit(1).alias("v"), none.alias("name")).unionByName(
        found.select("parent", F.col("first").alias("at"), F.lit(0).alias("v"), "name"))
    counted = group_running_sum(both, ["parent"], ["at", "v"], "v", before="before").where("name IS NOT NULL").select("name", "before")
    return found.select("name", "parent", "k").join(counted, "name")


def _by_depth(numbers: DataFrame, names: DataFrame) -> DataFrame:
    """(name, parent, k, passed) of all numbered names, from the unnumbered ones down."""
    level = names.select(F.col("_safe").alias("parent")).join(numbers.select(F.col("name").alias("parent")), "parent", "left_anti").withColumn("keeps", F.lit(1))
    done = None
    while True:
        below = numbers.join(level, "parent").withColumn("searchers", F.greatest(F.col("before") - F.col("keeps"), F.lit(0)))
        lists = below.groupBy("parent").agg(F.array_sort(F.collect_list(F.struct("k", "searchers", "name"))).alias("all"))
        pairs = F.arrays_zip(F.col("all"), _passed(F.col("all")).alias("passed"))
        found = lists.select("parent", F.explode(pairs).alias("x")).select(
            F.col("x.all.name").alias("name"), "parent", F.col("x.all.k").alias("k"), F.col("x.passed").alias("passed"))
        found = _written(found, "name-numbers")
        done = found if done is None else done.unionByName(found)
        if found.isEmpty():
            return done
        level = found.select(F.col("name").alias("parent"), F.col("passed").cast("int").alias("keeps"))


def unique_names(df: DataFrame, name_col: str, order_col: str, out: str = "file_name") -> DataFrame:
    """``df`` with ``out``, the name each row gets when rows take names in the order of ``order_col`` (unique)."""
    base = df.withColumn("_safe", T.safe_name(F.col(name_col)))
    ranked = group_rank(base, ["_safe"], [order_col], name="_r")
    names = _written(base.groupBy("_safe").agg(F.min(order_col).alias("first")), "names")
    numbers = _written(_numbers(base, names, order_col), "name-numbers")
    columns = [*df.columns, out]
    if numbers.isEmpty():
        return _named(ranked.withColumn("_j", F.col("_r") - 1).withColumn("_gaps", F.lit(0)), out).select(columns)
    known = _by_depth(numbers, names)
    made = known.where("NOT passed").select(F.col("name").alias("_safe"), F.lit(1).alias("_made"))  # names taken before their first record
    rows = ranked.join(made, "_safe", "left").withColumn("_j", F.col("_r") - 1 + F.coalesce("_made", F.lit(0)))
    gaps = known.where("passed").select(F.col("parent").alias("_safe"), "k")
    # the i-th passed number, k, stands before the searchers from k - i + 1 on
    i = group_rank(gaps, ["_safe"], ["k"], name="i").select("_safe", (F.col("k") - F.col("i") + 1).alias("_j"))
    i = _written(i, "name-gaps")
    with_gaps = i.select("_safe").distinct()
    plain = rows.join(with_gaps, "_safe", "left_anti").withColumn("_gaps", F.lit(0).cast("bigint"))
    hurdles = i.select("_safe", "_j", F.lit(1).alias("_v"))
    own = rows.join(with_gaps, "_safe", "left_semi").withColumn("_v", F.lit(0)).withColumn("_at", F.col(order_col))
    summed = group_running_sum(own.unionByName(hurdles, allowMissingColumns=True), ["_safe"], ["_j", F.col("_v").desc(), "_at"], "_v", before="_gaps")
    return _named(plain, out).select(columns).unionByName(_named(summed.where("_v = 0"), out).select(columns))


def _named(rows: DataFrame, out: str) -> DataFrame:
    number = (F.col("_j") + F.col("_gaps")).cast("string")
    return rows.withColumn(out, F.when(F.col("_j") == 0, F.col("_safe")).otherwise(F.concat_ws("_", "_safe", number)))
