"""Session set-up and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Flags every ladle job relies on.  Duplicate JSON keys keep the last value, as
# Python's json module does; timestamps are rendered in UTC.
SESSION_FLAGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

REQUIRED_FLAGS = ("spark.sql.variant.allowDuplicateKeys",)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime flags ladle needs to an existing session."""
    for key, value in SESSION_FLAGS.items():
        try:
            spark.conf.set(key, value)
        except Exception:
            if key in REQUIRED_FLAGS and spark.conf.get(key, None) != value:
                raise  # parse results would change silently
    return spark


def get_session(master: str | None = None, app: str = "ladle", shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with ladle's flags.  ``master`` is only for local runs."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # checkpoints written by global_rank are removed once their DataFrame is gone
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs everything in the driver JVM
            builder = builder.config("spark.driver.memory", os.environ.get("LADLE_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SESSION_FLAGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session (tests, bench) with
    nothing configured gets a fresh private folder; on a cluster an unset value
    is an error, because a machine-local folder would not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns spark.checkpoint.dir
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running ladle jobs")
        configured = tempfile.mkdtemp(prefix="ladle-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables.

    Results that read it are lazy, so it goes when the process ends.
    """
    path = os.path.join(checkpoint_dir(spark), f"{name}-{os.urandom(6).hex()}")
    if not _scratch:
        atexit.register(remove_scratch)
    _scratch.append((spark, path))
    return path


def remove_scratch() -> None:
    """Delete the scratch folders of this process, on whatever file system they are."""
    for spark, path in _scratch:
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended: its shared folder is the cluster's to clean
            break
    _scratch.clear()
