"""Word streams and Arrow plumbing for the operators that read texts in Python workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.common import fold

#: entries of a per-worker word cache and longest word kept in it: bounds memory, not results
CACHE_WORDS = 150_000
CACHE_WORD_BYTES = 40


class WordCache(dict):
    """word -> value computed by ``make``, kept for the first ``limit`` short words of a worker."""

    def __init__(self, make: Callable, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        value = self.make(word)
        if len(self) < self.limit and len(word) <= CACHE_WORD_BYTES:
            self[word] = value
        return value


def slices(texts: pa.StringArray, rows: int = 2048, size: int = 16 << 20) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of at most ``rows`` texts and ``size`` bytes (a longer text is a run of its own)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + size, side="right"))
        stop = min(max(stop, start + 1), start + rows)
        yield start, stop - start
        start = stop


class DistinctWords:
    """Words between ASCII white space of an array of texts, each distinct one once.

    ``words`` are the distinct ones, ``code`` the number of each word in reading order, and text k's
    words are ``code[ends[k]:ends[k + 1]]``.  Null texts have none.
    """

    def __init__(self, texts: pa.StringArray):
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        found = pc.dictionary_encode(split.flatten())
        self.words, self.code = found.dictionary, found.indices.to_numpy()
        self.ends = split.offsets.to_numpy() - split.offsets[0].as_py()


def word_ids(cache: WordCache, words: list, dtype=np.int64) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=dtype, count=len(words))


def hash32(data: bytes, seed: int = 0) -> int:
    return xxhash.xxh32_intdigest(data, seed)


def small_batches(spark: SparkSession, rows: int = 2048) -> None:
    """At most so many rows in an Arrow batch from now on: a batch of whole documents is MBs, not a few KB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def map_texts(df: DataFrame, text_col: str, keep: list[str], run: Callable, schema: str, as_arrow: bool = False) -> DataFrame:
    """Arrow batches of (keep..., text) through ``run(texts) -> list of arrays``.

    ``run`` is made once per task by calling the given factory; its arrays follow
    the kept columns.  Texts reach it as a list of bytes (null: None), or with ``as_arrow``
    as a string array.  A text column that is kept travels once.
    """
    small_batches(df.sparkSession)
    at = keep.index(text_col) if text_col in keep else len(keep)
    sent = keep if text_col in keep else [*keep, text_col]
    types = dict(df.dtypes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = run()
        for batch in batches:
            texts = batch.column(at)
            added = fn(texts if as_arrow else texts.cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + added, names=names)
    out_schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [schema])
    names = [f.name for f in df.sparkSession.createDataFrame([], out_schema).schema.fields]
    return df.select(*[F.col(f"`{c}`") for c in sent]).mapInArrow(task, out_schema)


#: labelled ids (a number each) up to which the list of them is broadcast
BROADCAST_IDS = 1 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int, per_class: int | None,
                    id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = (),
                    shard_rows: int | None = None) -> tuple[DataFrame, dict[int, int]]:
    """The labelled rows (doc_id, label, text, more...), none held out: all, or at most about ``per_class`` of each class.

    Rows are chosen by hash of the id, so the sample does not depend on partitioning.  A short id list
    is broadcast: the texts of other rows are then never shuffled.
    Ids repeated in a table count once.  Also returns the class counts of all usable rows.  With ``shard_rows`` a column ``shard`` (first)
    deals the rows by hash into parts of about so many, and a part's rows are in one partition.
    """
    usable = (labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("label"))
                    .where(F.col("l_id").isNotNull() & F.col("label").isin(0, 1) & (fold("l_id", mod) != held))
                    .groupBy("l_id").agg(F.max("label").alias("label")))
    n = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen, rows = usable, sum(n.values())
    if per_class is not None:
        draw = F.pmod(F.xxhash64("l_id", F.lit(17)), F.lit(1_000_000))
        share = F.when(F.col("label") == 1, F.lit(1e6 * min(1.0, per_class / max(n.get(1, 0), 1)))).otherwise(
            F.lit(1e6 * min(1.0, per_class / max(n.get(0, 0), 1))))
        chosen, rows = usable.where(draw < share), sum(min(k, per_class) for k in n.values())
    columns = {"doc_id": F.col(f"`{id_col}`"), "text": F.coalesce(F.col(f"`{text_col}`"), F.lit(""))} | {c: F.col(f"`{c}`") for c in more}
    texts = docs.select(*[c.alias(k) for k, c in columns.items()])
    joined = texts.join(F.broadcast(chosen) if rows <= BROADCAST_IDS else chosen, F.col("doc_id") == F.col("l_id"))
    keys = ["doc_id"]
    if shard_rows:
        shards, keys = max(1, -(-rows // shard_rows)), ["shard", "doc_id"]
        joined = joined.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(shards))).repartition(shards, "shard")
    one = joined.groupBy(*keys).agg(F.first("label").alias("label"), F.min(F.struct("text", *more)).alias("s"))
    return one.select(*keys, "label", "s.*"), n


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))
