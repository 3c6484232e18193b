"""The corpus pipeline: toxicity, exact duplicates, near duplicates, benchmark decontamination, packing.

Every stage takes what its predecessor kept, applies its operator to all of it and carries the decisions out; all but the
last return the columns of documents.  Stages select rows by (id, text) without regard to other columns, so columns with
names that operators use themselves pass through unharmed.  Null ids are ids of their own; of repeated rows one stays from
the second stage on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cartwheel.llm import decontaminate, exact_dedup, jaccard_join, labelled, packing, toxicity
from cartwheel.llm.queries import tokenizer_path
from cartwheel.llm.spread import written

#: a text this likely to be toxic is rejected
TOXIC = 0.3
SEQUENCE, END_ID = 1024, 2


def _kept(docs: DataFrame, keys: DataFrame, text: Column) -> DataFrame:
    """The rows whose id and text digest are among the keys; of equal ones a single row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                       text.alias("sha"))
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("id", "sha")]
    found = rows.alias("d").join(keys.alias("k"), on, "left_semi")
    nth = F.row_number().over(Window.partitionBy("id", "sha").orderBy(F.lit(1)))
    return found.withColumn("nth", nth).where("nth = 1").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: rejects documents that score at least TOXIC; learns from the labels outside the held-out quarter."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~labelled.held_out("id", 4, 2))
    # the rest of the row travels with its text, so no join is needed; the names of its parts are their places
    rest = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns) if c != "text"]
    packed = docs.select(F.struct(*rest).alias("row"), F.col("text"))
    kept = toxicity.score(packed, model, "row", keep_text=True).where(F.col("score") < TOXIC)
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row._{i}").alias(c) for i, c in enumerate(docs.columns)])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of equal texts the row with the largest id stays."""
    found = exact_dedup.exact_groups(docs, keep="max").where("kept")
    keys = written(spark, found.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")), "kept")
    return _kept(docs, keys, F.sha2(F.coalesce("text", F.lit("")), 256))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of every component of five-word shingle sets at 0.8 the row with the smallest id stays.

    Of rows with that id the smallest text digest decides; a null id comes after all others.  Texts without shingles stay.
    """
    found = jaccard_join.jaccard_components(docs, grouped=True).withColumnRenamed("doc_id", "id")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "sha")).alias("first")
    keys = (found.where(F.col("group").isNotNull()).groupBy("group").agg(first).select("first.id", "first.sha")
            .unionByName(found.where(F.col("group").isNull()).select("id", "sha")).distinct())
    return _kept(docs, written(spark, keys, "kept"), jaccard_join.text_digest())


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold ten words in a row of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "documents")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: what is left, as pieces of sequences."""
    return packing.pack_documents(docs, tokenizer_path(), SEQUENCE, END_ID)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies),
          ("decontaminate", drop_contaminated), ("packing", pack)]

#: the first and the last stage are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
