"""Extract, bronze landing, fact transform and the high-water mark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.scalars import date_key, ts

BRONZE_COLUMNS = ["OrderItemId", "OrderId", "CustomerId", "ProductId", "OrderDate", "Quantity", "UnitPrice",
                  "LineTotal"]
FACT_COLUMNS = ["DateKey", "CustomerKey", "ProductKey", "OrderId", "OrderItemId", "Quantity", "UnitPrice", "LineTotal"]


def incremental_extract(items: DataFrame, orders: DataFrame, watermark) -> DataFrame:
    """Lines above the mark with the date and customer of their order, null where there is no such order.

    One job takes all new lines, in no order; nothing is paged through.
    """
    return (items.where(F.col("OrderItemId") > watermark)
            .join(orders.select("OrderId", "CustomerId", "OrderDate"), "OrderId", "left").select(BRONZE_COLUMNS))


def bronze_new_rows(batch: DataFrame, bronze: DataFrame, key: str) -> DataFrame:
    """Rows of the batch whose key is not landed yet, one per key.

    Copies inside the batch collapse to the smallest row: a minimum combines before the shuffle, so a line delivered
    over and over does not pile up in one task.
    """
    rest = [c for c in batch.columns if c != key]
    once = batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*").select(batch.columns)
    return once.join(bronze.select(key), key, "left_anti").select(batch.columns)


def landed(rows: DataFrame, as_of: datetime, source: str = "OLTP") -> DataFrame:
    return rows.withColumn("IngestedAt", ts(as_of)).withColumn("SourceSystem", F.lit(source))


def resolve_keys(items: DataFrame, orders: DataFrame, customer_keys: DataFrame, product_keys: DataFrame,
                 also: list[str] | None = None) -> DataFrame:
    """Lines with the date key and both surrogate keys, null where a lookup finds nothing.

    The customer is looked up on the order, before the lines are joined: fewer rows move.  Neither lookup is forced
    to broadcast, Spark does so by itself while the side is under the threshold.  ``also`` names further equi-join
    columns (the load number) that the order and both lookups share.
    """
    also = also or []
    known = orders.join(customer_keys, ["CustomerId", *also], "left")
    lines = items.join(known, ["OrderId"], "left").join(product_keys, ["ProductId", *also], "left")
    return lines.withColumn("DateKey", date_key(F.col("OrderDate")))


def _complete():
    return F.col("DateKey").isNotNull() & F.col("CustomerKey").isNotNull() & F.col("ProductKey").isNotNull()


def silver_fact(resolved: DataFrame, as_of: datetime) -> DataFrame:
    """Lines whose order and two lookups were found."""
    return (resolved.where(_complete())
            .select(*FACT_COLUMNS, ts(as_of).alias("EtlLoadedAt")))


def fact_quarantine(resolved: DataFrame) -> DataFrame:
    """The other lines, with the lookup that failed first: the mark passes them, so they would be lost."""
    reason = (F.when(F.col("DateKey").isNull(), F.lit("unknown order"))
              .when(F.col("CustomerKey").isNull(), F.lit("unknown customer")).otherwise(F.lit("unknown product")))
    return (resolved.where(~_complete())
            .select("OrderItemId", "OrderId", "CustomerId", "ProductId", "DateKey", "Quantity", "LineTotal",
                    reason.alias("Reason")))


def advance_watermark(state: DataFrame, batch: DataFrame, pipeline: str, as_of: datetime) -> DataFrame:
    """One row per pipeline after the batch; an empty batch leaves the mark and its time alone."""
    seen = batch.agg(F.max("OrderItemId").alias("LastProcessedRowId")).where("LastProcessedRowId is not null").select(
        F.lit(pipeline).alias("PipelineName"), "LastProcessedRowId", ts(as_of).alias("LastProcessedAt"))
    rows = state.select("PipelineName", "LastProcessedRowId", "LastProcessedAt").unionByName(seen)
    latest = F.max_by(F.struct("LastProcessedRowId", "LastProcessedAt"), F.col("LastProcessedAt"))
    return rows.groupBy("PipelineName").agg(latest.alias("_row")).select("PipelineName", "_row.*")


def read_watermark(state: DataFrame, pipeline: str) -> int:
    """The mark of a pipeline, 0 when it has none (one row reaches the driver)."""
    row = state.where(F.col("PipelineName") == pipeline).agg(F.max("LastProcessedRowId")).first()
    return int(row[0] or 0)
