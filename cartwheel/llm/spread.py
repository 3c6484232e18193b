"""Joins that stay even when one key holds a third of the rows, and tables in the shared work folder."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.session import work_dir

#: a key is hot from this share of the rows on, so there are at most 1 / HOT_SHARE hot keys to broadcast
HOT_SHARE = 0.001
#: a narrow table of at most so many keys is broadcast whole
FEW_KEYS = 20_000
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table below ``spark.checkpoint.dir``, read again: its lineage ends at shared files."""
    path = work_dir(spark, name)
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    _folders[table] = path
    return table


def dropped(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Removes tables made by ``written`` whose every reader has been written itself."""
    for table in tables:
        if table is not None and table in _folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_key(rows: DataFrame, per_key: DataFrame, key: str, copies: str, narrow: bool = False) -> DataFrame:
    """Rows joined with the one row of their key; ``copies`` in ``per_key`` counts the rows of a key.

    The few hot keys (at most 1 / HOT_SHARE, by their counts) are broadcast, so their rows stay where they are; the others
    meet in a shuffle.  Both frames are read twice: give tables, not computations.  ``narrow`` says that ``per_key`` holds
    numbers only; then at most FEW_KEYS keys are all broadcast.
    """
    total, keys = per_key.agg(F.coalesce(F.sum(copies), F.lit(0)), F.count(F.lit(1))).first()
    if narrow and keys <= FEW_KEYS:
        return rows.join(F.broadcast(per_key), key)
    hot = F.col(copies) >= F.lit(max(2.0, total * HOT_SHARE))
    few = per_key.where(hot)
    at_hot = rows.join(F.broadcast(few), key)
    rest = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(per_key.where(~hot), key)
    return at_hot.unionByName(rest)
