"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every job relies on.  The broadcast threshold is left as the cluster sets it: Spark compares it
#: with the measured size of a side, and falls back to a shuffled join above it.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when the next aggregation then needs its own exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a side is planned for broadcast by its file size: Parquet holds key columns in about a sixteenth of what a hash
    # table of them takes on the driver
    "spark.sql.sources.fileCompressionFactor": "16.0",
    # what one task reads: rows of keys and amounts grow several times from file to memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
#: a shuffle begins with at least this many partitions, which adaptive execution merges up to the advisory size: the
#: memory of a task is bounded by that size, whatever number the session came with
PARTITIONS = 400
#: whether a query deletes its shuffle files as it ends
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: seconds between two collections that ``released`` asks for
RELEASE_EVERY = 1.0
_last_release = 0.0


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by someone else."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    given = spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(first, str(max(int(given), PARTITIONS)))
    return spark


def build_session(app: str = "cartwheel", cores: str | int = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables and stream checkpoints, below ``spark.checkpoint.dir``.

    Only a local session may go without that setting: its one machine then holds the folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = os.path.join(tempfile.gettempdir(), "cartwheel")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the work folder, read again: its lineage ends at shared files."""
    path = work_dir(spark, name)
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    _folders[table] = path
    return table


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Removes tables made by ``written`` whose every reader has been written itself."""
    for table in tables:
        if table in _folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Inside, a query whose rows are fetched deletes its shuffle files as it ends; for one that writes see ``released``."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of writes that are over.

    Spark deletes them when the driver's garbage is collected, and a job of many writes, whose driver has little to
    collect, would keep those of all of them.  What is left is at most what ``RELEASE_EVERY`` seconds wrote.
    """
    global _last_release
    if time.monotonic() - _last_release >= RELEASE_EVERY:
        gc.collect()  # frames in Python's cycles hold their plans, and these their shuffles
        spark.sql("SELECT 1").collect()  # Spark's listeners hold the plan that ended last, until another one ends
        spark._jvm.System.gc()
        _last_release = time.monotonic()
