"""Parquet tables with atomic multi-table commits.

Plain parquet has no MERGE and no transactions.  So data always goes to a new folder, and becomes visible through one
appended row in the ``commits`` table.  A batch that writes bronze, fact and watermark is committed by a single file;
a job that dies before that leaves nothing visible, and a retry carries the same token and is recognised.

A commit row either appends a folder to a table or replaces all folders before it.  One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartwheel.session import released

COMMITS = T.StructType([
    T.StructField("CommitId", T.LongType()), T.StructField("Token", T.StringType()),
    T.StructField("TableName", T.StringType()), T.StructField("Mode", T.StringType()),
    T.StructField("Path", T.StringType()), T.StructField("Watermark", T.LongType()),
    T.StructField("At", T.TimestampNTZType())])


#: how the tokens of the load begin
LOAD_TOKENS = ("batch-", "etl-stream-")


@dataclass(frozen=True)
class Staged:
    """A written folder that no commit names yet.  Without a path, a replace empties the table."""
    table: str
    mode: str
    path: str | None


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as literals of one task: written, they are one file and appear together or not at all."""
    structs = [F.struct(*[(F.lit(str(v)) if isinstance(v, datetime) else F.lit(v)).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields, strict=True)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._known: list | None = None
        self._schemas: dict[str, T.StructType] = {}
        self._opened: dict[tuple, DataFrame] = {}

    # ---- commits: a few rows per batch, the only thing that ever reaches the driver
    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")

    def _log(self) -> list:
        """Commit rows in order, read once per object: this process is the only writer."""
        if self._known is None:
            try:
                self._known = self.commits().orderBy("CommitId").collect()
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":  # anything else is a broken log, not an empty one
                    raise
                self._known = []
        return self._known

    def done(self, token: str) -> bool:
        """Whether a commit carries the token; a reset forgets the tokens of the load it resets, no others."""
        seen = False
        for row in self._log():
            forgets = row.Token.startswith("reset-") and token.startswith(LOAD_TOKENS)
            seen = (seen or row.Token == token) and not forgets
        return seen

    def last_commit(self, table: str) -> int:
        """The number of the last commit that names the table, 0 for none."""
        return max((row.CommitId for row in self._log() if row.TableName == table), default=0)

    def covered(self, name: str) -> int:
        """The last commit that a derived table has told to cover, 0 for none."""
        return next((row.Watermark for row in reversed(self._log()) if row.TableName == f"covers:{name}"), 0)

    def since(self, table: str, commit: int) -> DataFrame | None:
        """The rows appended after a commit; None if none were, or if the table was replaced since."""
        rows = [r for r in self._log() if r.TableName == table and r.CommitId > commit]
        if not rows or any(r.Mode == "replace" for r in rows):
            return None
        return self._open(table, [r.Path for r in rows])

    def watermark(self, pipeline: str) -> int:
        marks = [row.Watermark for row in self._log() if row.TableName == f"watermark:{pipeline}"]
        return marks[-1] if marks else 0

    def watermarks(self) -> DataFrame:
        """Watermark table: the last mark of every pipeline with the time it moved."""
        marks = self.commits().where(F.startswith("TableName", F.lit("watermark:")))
        last = marks.groupBy("TableName").agg(F.max_by(F.struct("Watermark", "At"), "CommitId").alias("m"))
        return last.select(F.replace("TableName", F.lit("watermark:"), F.lit("")).alias("PipelineName"),
                           F.col("m.Watermark").alias("LastProcessedRowId"), F.col("m.At").alias("LastProcessedAt"))

    def commit(self, staged: Iterable[Staged], token: str, as_of: datetime,
               marks: dict[str, int] | None = None, covers: dict[str, int] | None = None) -> None:
        number = max((row.CommitId for row in self._log()), default=0) + 1
        rows = [(number, token, s.table, s.mode, s.path, None, as_of) for s in staged]
        rows += [(number, token, f"watermark:{name}", "mark", None, mark, as_of)
                 for name, mark in (marks or {}).items()]
        rows += [(number, token, f"covers:{name}", "mark", None, upto, as_of) for name, upto in (covers or {}).items()]
        literal_rows(self.spark, rows, COMMITS).write.mode("append").parquet(f"{self.root}/commits")
        self._log().extend(T.Row(*COMMITS.fieldNames())(*row) for row in rows)

    # ---- data
    def stage(self, table: str, frame: DataFrame, mode: str = "append", partition: str | None = None,
              order: str | None = None) -> Staged:
        """Write a frame to a fresh folder.

        With a partition column, rebalancing gathers each value into few files and splits the large ones; rows may
        also be sorted inside a file.  A table that is replaced as a whole is rebalanced into even files.
        """
        path = f"{self.root}/{table}/part=p{uuid.uuid4().hex}"
        self._schemas[table] = frame.schema
        if partition:
            even = frame.hint("rebalance", F.col(partition))
            even = even.sortWithinPartitions(partition, order) if order else even
            even.write.partitionBy(partition).parquet(path)
        else:
            (frame.hint("rebalance") if mode == "replace" else frame).write.parquet(path)
        released(self.spark)
        return Staged(table, mode, path)

    def stage_all(self, frames: dict[str, DataFrame], mode: str = "append") -> list[Staged]:
        """Write frames one after the other: side by side, the shuffle files of all would be on disk at once."""
        return [self.stage(table, frame, mode) for table, frame in frames.items()]

    def _open(self, table: str, folders: list[str]) -> DataFrame:
        """Folders never change once written, so their listing is kept for as long as this object lives."""
        key = (table, *folders)
        if key not in self._opened:
            reader = self.spark.read.option("basePath", f"{self.root}/{table}")
            if table not in self._schemas:
                self._schemas[table] = reader.parquet(folders[-1]).drop("part").schema
            self._opened[key] = reader.schema(self._schemas[table]).parquet(*folders).drop("part")
        return self._opened[key]

    def open(self, staged: Staged) -> DataFrame:
        return self._open(staged.table, [staged.path])

    def paths(self, table: str, upto: int | None = None) -> list[str]:
        folders: list[str] = []
        for row in self._log():
            if row.TableName == table and (upto is None or row.CommitId <= upto):
                folders = ([] if row.Mode == "replace" else folders) + ([row.Path] if row.Path else [])
        return folders

    def read(self, table: str, upto: int | None = None) -> DataFrame | None:
        """The committed rows of a table (as of a commit), None while it has no folder."""
        folders = self.paths(table, upto)
        return self._open(table, folders) if folders else None
