"""Incremental ingest with Structured Streaming.

Every document is processed exactly once, whatever file or run brings it: the source remembers the
files that it has read (``file_lists``: whole text files are listed by tasks, and only lists of files reach the driver), keyed state remembers the documents (a stem that comes again changes
nothing), and the parquet sink commits each micro-batch atomically.  ``trigger(availableNow=True)`` drains
whatever is there and stops, so the same job serves as a batch catch-up and as a scheduled stream.

Counters are kept by micro-batch: a batch writes its own counts, under its id, and a replayed batch
writes the same ones again, so they never count twice and nothing written earlier is rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOC_SCHEMA = "rid string, text string"


def read_text_stream(spark: SparkSession, in_dir: str, glob: str = "*.txt", files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of a folder of whole text files: (rid, text), rid being the file's stem."""
    from ladle.sources.io import file_name, normalise_newlines, path_stem, whole_files
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df, text = whole_files(reader, in_dir, glob)
    return df.select(path_stem(file_name()).alias("rid"), normalise_newlines(text).alias("text"))


def read_stream(spark: SparkSession, in_dir: str, schema: str = DOC_SCHEMA, fmt: str = "json",
                files_per_trigger: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """Streaming scan of a folder that receives new files (``files_per_trigger`` bounds a
    micro-batch; None keeps Spark's default).  ``fmt="files"`` takes whole text files named by stem; given
    the ``checkpoint``, the driver holds none of their names."""
    if fmt == "files":
        from ladle.streaming.file_lists import listable, read_listed
        if checkpoint and listable(spark, in_dir, checkpoint):
            return read_listed(spark, in_dir, checkpoint, "*.txt", files_per_trigger)
        return read_text_stream(spark, in_dir, files_per_trigger=files_per_trigger)
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(in_dir)


#: listing many new files is a Spark job of up to 10,000 tasks in each micro-batch; one task a core is enough
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: the keys seen so far are kept on disk beside the executors, not in their heaps
_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    """Settings that a stream takes over when it starts; the session's own state store is kept."""
    wanted = {k: v for k, v in _STATE.items() if spark.conf.get(k, None) is None}
    wanted[_LISTING] = str(min(int(spark.conf.get(_LISTING, None) or 10000), spark.sparkContext.defaultParallelism))
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _once(source: DataFrame, transform: Callable[[DataFrame], DataFrame], key: str | None) -> DataFrame:
    """The transformed documents, each key once for the life of the checkpoint.  State holds the keys seen; it is
    applied behind the transform where that keeps the key, so that whole texts are not shuffled."""
    if key is None:
        return transform(source)
    out = transform(source)
    return out.dropDuplicates([key]) if key in out.columns else transform(source.dropDuplicates([key]))


def ingest_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame], schema: str = DOC_SCHEMA, fmt: str = "json",
                  files_per_trigger: int | None = None, key: str | None = "rid") -> int:
    """Process every new document once into a parquet table; ``key`` names the column that tells documents apart (None:
    every row of every new file counts).  Returns the number of micro-batches since the checkpoint began (its last
    batch id, as Spark keeps only the latest progress reports)."""
    out = _once(read_stream(spark, in_dir, schema, fmt, files_per_trigger, checkpoint), transform, key)
    with _settings(spark):
        q = (out.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    last = q.lastProgress
    return last["batchId"] + (1 if last["numInputRows"] else 0) if last else 0


def add_batch(batch: DataFrame, batch_id: int, out_dir: str, key: str) -> None:
    """Write one micro-batch's counts under its id, in place of those of an earlier attempt."""
    counts = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))  # one row a key
    counts.coalesce(1).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")


def read_counts(spark: SparkSession, out_dir: str, key: str = "outcome") -> DataFrame:
    """The running counts: all batches' counts added up (a few rows a batch)."""
    return spark.read.parquet(out_dir).groupBy(key).agg(F.sum("n").alias("n"))


def stream_counts(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame], key: str = "outcome",
                  schema: str = DOC_SCHEMA, fmt: str = "json", files_per_trigger: int | None = None, doc_key: str | None = "rid") -> None:
    """Running counts per ``key`` over every document ingested so far (``read_counts`` reads them)."""
    docs = _once(read_stream(spark, in_dir, schema, fmt, files_per_trigger, checkpoint), transform, doc_key)
    with _settings(spark):
        q = (docs.writeStream.outputMode("append").foreachBatch(lambda batch, batch_id: add_batch(batch, batch_id, out_dir, key))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
