"""CSV records of splittable files, cells with newlines included (A1).

A newline inside a quoted cell ends no record, so a task that starts in the middle of a file cannot
know whether its first line starts a record.  The file is therefore scanned twice, in Spark's own
file splits, and never by one task:

1. Speculation.  Each line says where it ends (inside or outside a quoted cell) under both
   assumptions about where it starts.  These two answers make a line constant, neutral or
   a flip, and so a whole split; only lines with a quote are looked at.  A running pass over the splits of each
   file (one row a split) then tells where every split really starts.
2. Assembly.  Lines are joined to records inside each split, in file order.  A record that goes
   on in the next split leaves as pieces (at most two a split), which are put together by file order.

Nothing the size of the data is shuffled.  Lines end in LF or CRLF; a quote that does not
start a cell is an ordinary character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.session import scratch_dir

# One cell that ends on its line, and an opened cell that does not.  Possessive, so linear and without recursion.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
_LEFT_OPEN = rf'(?:{_CELL},)*+"[^"]*+(?:""[^"]*+)*+\z'
OPEN_FROM_OUTSIDE = rf"\A{_LEFT_OPEN}"
OPEN_FROM_INSIDE = rf'\A[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,{_LEFT_OPEN})'

#: splits with something to say (they start inside a cell, hold pieces or are not UTF-8) that may be broadcast, about 150 bytes each
MAX_BROADCAST_SPLITS = 200_000
_ASSEMBLED = "file string, block bigint, place int, opens boolean, closes boolean, first boolean, record string"


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _ends(value: Column) -> tuple[Column, Column]:
    """Whether a line ends inside a cell if it starts outside one, and if it starts inside one."""
    quoted = F.contains(value, F.lit('"'))
    return quoted & F.rlike(value, F.lit(OPEN_FROM_OUTSIDE)), ~quoted | F.rlike(value, F.lit(OPEN_FROM_INSIDE))


def splits(spark: SparkSession, path) -> DataFrame:
    """One row a split: file, block, inside (it starts inside a cell), next_inside, latin (its file is not UTF-8)."""
    lines = _lines(spark, path).select("*", F.monotonically_increasing_id().alias("line"))
    outside, inside = _ends(F.col("value"))
    said = lines.select("file", "block", "line", F.is_valid_utf8("value").alias("fine"), outside.alias("o"), inside.alias("i"))
    # neutral lines only count for the encoding; the others go by split, as a few numbers each
    plain = said.groupBy("file", "block").agg(F.min("fine").alias("fine"))
    order = Window.partitionBy("file", "block").orderBy("line")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    turns = said.where("o OR NOT i").select("file", "block", "line", "o", "i", F.sum(F.when(F.col("o") & ~F.col("i"), 1).otherwise(0)).over(run).alias("flips"))
    settled = F.when(F.col("o") == F.col("i"), (F.col("o").cast("int") + F.col("flips")) % 2)
    whole = turns.groupBy("file", "block").agg(F.max("flips").alias("flips"), F.max_by(settled, F.when(settled.isNotNull(), F.col("line"))).alias("settled"))
    known = plain.join(whole, ["file", "block"], "left").select(
        "file", "block", "fine", F.coalesce("flips", F.lit(0)).alias("flips"), "settled")
    # the same composition over the splits of a file: where the last constant one left off, and the flips since
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    all_flips = F.coalesce(F.sum("flips").over(before), F.lit(0))
    known = known.withColumn("upto", all_flips)
    base = F.when(F.col("settled").isNotNull(), (F.col("settled") + F.col("upto")) % 2)
    start = F.pmod(F.coalesce(F.last(base, ignorenulls=True).over(before), F.lit(0)) + F.col("upto"), F.lit(2)) == 1
    of_file = Window.partitionBy("file")
    found = known.select("file", "block", start.alias("inside"), (~F.min("fine").over(of_file)).alias("latin"))
    return found.withColumn("next_inside", F.coalesce(F.lead("inside").over(Window.partitionBy("file").orderBy("block")), F.lit(False)))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines (value, file, block, inside, o, i), split by split."""
    key, state, open_lines, whole, rows, first = None, False, [], True, [], False

    def row(text: str, closes: bool) -> None:
        nonlocal first, whole
        done = whole and closes
        rows.append((None if done else key[0], None if done else key[1], int(whole), whole, closes, first, text))
        first, whole = False, True

    def out() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        names = ["file", "block", "place", "opens", "closes", "first", "record"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        rows.clear()
        return batch
    for batch in batches:
        value, file, block, inside, o, i = batch.columns
        blocks, files = block.to_numpy(), pc.dictionary_encode(file)
        codes = files.indices.to_numpy()
        change = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
        bounds = [0, *change.tolist(), len(batch)]
        for x, y in zip(bounds[:-1], bounds[1:]):
            here = (files.dictionary[int(codes[x])].as_py(), int(blocks[x]))
            if here != key:
                if open_lines:
                    row("\n".join(open_lines), False)
                state, open_lines, first = bool(inside[x].as_py()), [], here[1] == 0
                key, whole = here, not state
            from_outside, from_inside = (c.slice(x, y - x).to_numpy(zero_copy_only=False).astype(bool) for c in (o, i))
            flips = np.cumsum(from_outside & ~from_inside) & 1
            fixed = np.maximum.accumulate(np.where(from_outside == from_inside, np.arange(y - x), -1))
            after = np.where(fixed >= 0, (from_outside ^ (flips == 1))[fixed], state) ^ (flips == 1)
            starts = np.flatnonzero(~np.append(state, after[:-1]))
            lines = value.slice(x, y - x).to_pylist()
            state = bool(after[-1])
            at = int(starts[0]) if len(starts) else len(lines)
            open_lines += lines[:at]
            if open_lines and (len(starts) or not state):
                row("\n".join(open_lines), True)
                open_lines = []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(lines)]):
                if e == len(lines) and state:
                    open_lines = lines[s:]
                else:
                    row(lines[s] if e == s + 1 else "\n".join(lines[s:e]), True)
        if rows:
            yield out()
    if open_lines:
        row("\n".join(open_lines), False)
        yield out()


def csv_records(spark: SparkSession, path, latin: bool | None = None) -> DataFrame:
    """(record, first): the text of every CSV record under ``path`` (decoded; no line end), ``first`` being a file's first.

    ``latin`` says whether the files are Latin-1; by default those that are not valid UTF-8 are.
    Empty lines between records are left out.
    """
    folder = scratch_dir(spark, "csv-splits")
    found = splits(spark, path)
    found = (found if latin is None else found.withColumn("latin", F.lit(latin))).where("inside OR next_inside OR latin")
    found.write.parquet(folder)
    told = spark.read.schema(found.schema).parquet(folder)
    n, cut = told.agg(F.count(F.lit(1)), F.count_if("inside")).first()
    at = F.broadcast(told) if n <= MAX_BROADCAST_SPLITS else told
    outside, inside = _ends(F.col("value"))

    def assembled(lines: DataFrame) -> DataFrame:
        text = F.when(F.col("latin"), F.decode(F.col("value").cast("binary"), "ISO-8859-1")).otherwise(F.col("value"))
        return lines.select(text.alias("value"), "file", "block", "inside", outside.alias("o"), inside.alias("i")).mapInArrow(_assemble, _ASSEMBLED)
    everything = assembled(_lines(spark, path).join(at, ["file", "block"], "left"))
    out = everything.where("opens AND closes").select("record", "first")
    if cut:
        pieces = assembled(_lines(spark, path).join(at, ["file", "block"]).where("inside OR next_inside")).where("NOT (opens AND closes)")
        folder = scratch_dir(spark, "csv-pieces")
        pieces.write.parquet(folder)  # read twice below; at most two rows a split
        order = Window.partitionBy("file").orderBy("block", "place")
        numbered = spark.read.schema(pieces.schema).parquet(folder).withColumn("number", F.sum(F.col("opens").cast("int")).over(order))
        parts = F.array_sort(F.collect_list(F.struct("block", "place", "record")))
        out = out.unionByName(numbered.groupBy("file", "number").agg(
            F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"), F.max("first").alias("first")).select("record", "first"))
    return out.select(F.regexp_replace("record", r"\r\z", "").alias("record"), "first").where("record <> ''")
