"""Table upkeep: file statistics, compaction, reset."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from cartwheel.schemas import PIPELINE
from cartwheel.sources.warehouse import Staged, Warehouse

SMALL_FILE_ROWS = 1_000_000


def file_stats(frame: DataFrame, small: int = SMALL_FILE_ROWS) -> DataFrame:
    """Files, files below the wanted size, and rows."""
    per_file = frame.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("Files"), F.count_if(F.col("n") < small).alias("SmallFiles"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("TotalRows"))


def compact_fact(wh: Warehouse, as_of: datetime, small: int = SMALL_FILE_ROWS) -> DataFrame | None:
    """Rewrite the fact into few even files per month, sorted by day; statistics before and after.

    Skipped (one row of statistics) when no file is small.  Readers keep the old folders until the commit.
    """
    fact = wh.read("fact")
    if fact is None:
        return None
    before = file_stats(fact, small).withColumn("Stage", F.lit("before"))
    if before.first()["SmallFiles"] == 0:
        return before
    staged = wh.stage("fact", fact, "replace", partition="MonthKey", order="DateKey")
    after = file_stats(wh.open(staged), small).withColumn("Stage", F.lit("after"))
    wh.commit([staged], f"compact-{uuid.uuid4().hex}", as_of)
    return before.unionByName(after)


def reset(wh: Warehouse, as_of: datetime) -> None:
    """Empty the fact and forget the watermark; dimensions, bronze and gold stay."""
    wh.commit([Staged("fact", "replace", None)], f"reset-{uuid.uuid4().hex}", as_of, {PIPELINE: 0})
