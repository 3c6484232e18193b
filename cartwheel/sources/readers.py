"""Readers for the other inputs: bulk feeds, the schema document and line-JSON question sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cartwheel import schemas as S


def read_feed(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """A CSV feed as strings with its row numbers; the header is row 1.

    Quoted cells may hold line breaks, which asks for one task a file; without ``multi_line`` large files are read in
    blocks, and a line break always ends the row.  Rows are numbered block by block: only one small row per file block is put in sequence, the rows themselves stay
    where they were read.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", True).option("multiLine", multi_line).csv(path)
    placed = raw.select("*", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_id"))
    blocks = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    before = F.sum("_rows").over(Window.partitionBy().orderBy("_file", "_block")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_rows")
    return (placed.join(starts, ["_file", "_block"])
            .select((F.col("_before") + F.col("_id") - F.col("_first") + 2).alias("RowNo"), *columns))


def read_schema_document(spark: SparkSession, path: str) -> DataFrame:
    """The whitelist document as one row; comments and trailing commas are allowed.

    Raises when the file is missing or names no table.
    """
    text = spark.read.text(path, wholetext=True)
    strict = F.regexp_replace("value", r",(\s*[\]}])", "$1")
    document = text.select(F.from_json(strict, S.SCHEMA_DOCUMENT, {"allowComments": "true"}).alias("d")).select("d.*")
    if document.where(F.size("tables") > 0).isEmpty():
        raise ValueError(f"{path} names no tables")
    return document


def schema_catalogue(document: DataFrame) -> DataFrame:
    """One row per whitelisted column: schema, table, column, type."""
    tables = document.select(F.col("defaultSchema").alias("fallback"), F.explode("tables").alias("t"))
    columns = tables.select(F.coalesce(F.nullif("t.schema", F.lit("")), "fallback").alias("SchemaName"),
                            F.col("t.name").alias("TableName"), F.explode("t.columns").alias("c"))
    return columns.select("SchemaName", "TableName", F.col("c.name").alias("ColumnName"),
                          F.col("c.type").alias("ColumnType"))


def canned_questions(document: DataFrame) -> DataFrame:
    """The worked examples of a schema document: question and statement."""
    return document.select(F.explode("fewShot").alias("e")).select("e.question", "e.sql")


#: question sets for accuracy, statement sets for safety
QUESTIONS = "id string, lang string, difficulty string, question string, sql string"
SAFETY = "name string, expect string, sql string"


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-JSON with a declared schema; blank lines are skipped."""
    return spark.read.schema(schema).json(path)
