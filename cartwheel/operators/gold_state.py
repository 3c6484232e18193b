"""Gold that a batch brings up to date without reading the whole fact again.

Two small tables beside the published ones make that possible.  ``product_months`` holds units and revenue of each product
version and month: sums, so a batch appends its own fold as one more part, and readers add the parts up.  It keeps every
product of a month, also those below the published best, so a product can come up later, and inventory and exact product
reports are sums over it.  ``order_mix`` holds the orders of a day by the set of categories they touch; since an order
has one date, the distinct orders of any days and any categories are a sum over it.

All functions take rows that were added; a fact that was replaced needs a full rebuild.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from cartwheel import schemas as S
from cartwheel.operators import gold


def product_months(rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Partial sums of fact rows per month and product version."""
    months = rows.select("DateKey", "ProductKey", "Quantity", "LineTotal").join(
        dim_date.select("DateKey", (F.col("Year") * 100 + F.col("Month")).alias("MonthKey")), "DateKey")
    return months.groupBy("MonthKey", "ProductKey").agg(F.sum("Quantity").alias("Quantity"),
                                                        F.sum("LineTotal").alias("LineTotal"))


def monthly_top_products(state: DataFrame, dim_product: DataFrame, top: int = S.TOP_PER_MONTH) -> DataFrame:
    """The published monthly lists from the parts of the state."""
    parts = state.select(F.floor(F.col("MonthKey") / 100).cast("int").alias("Year"),
                         (F.col("MonthKey") % 100).cast("int").alias("Month"), "ProductKey", "Quantity",
                         F.col("LineTotal").cast(S.WIDE_MONEY).alias("Revenue"))
    return gold.best_of_months(parts, dim_product, top)


def monthly_incremental(monthly: DataFrame, state: DataFrame, added: DataFrame, dim_product: DataFrame,
                        top: int = S.TOP_PER_MONTH) -> DataFrame:
    """Monthly lists after a batch: months of ``added`` are ranked again over ``state`` (which holds it), the rest stays.

    The months of a batch are at most those of the calendar, so they are broadcast and prune the parts to read.
    """
    touched = F.broadcast(added.select("MonthKey").distinct())
    redone = monthly_top_products(state.join(touched, "MonthKey", "left_semi"), dim_product, top)
    kept = monthly.withColumn("MonthKey", F.col("Year") * 100 + F.col("Month")).join(touched, "MonthKey", "left_anti")
    return kept.select(redone.columns).unionByName(redone)


def lifetime_value_incremental(values: DataFrame, new_rows: DataFrame, held: DataFrame, dim_date: DataFrame,
                               dim_customer: DataFrame, as_of: datetime) -> DataFrame:
    """Customer values after a batch.  ``held`` is the fact without the batch.

    Dates and revenue merge as they are.  An order counts again only if none of its lines was there before: it is looked
    up in the days that the batch touches, since an order keeps its date.
    """
    month = ["MonthKey"] if "MonthKey" in held.columns and "MonthKey" in new_rows.columns else []
    days = F.broadcast(new_rows.select("DateKey", *month).distinct())
    owner = dim_customer.select("CustomerKey", "CustomerId")
    before = (held.join(days, ["DateKey", *month], "left_semi").select("CustomerKey", "OrderId").distinct()
              .join(owner, "CustomerKey").select("CustomerId", "OrderId").distinct().withColumn("_known", F.lit(True)))
    fresh = (gold.order_values(new_rows, dim_date).join(owner, "CustomerKey").groupBy("CustomerId", "OrderId")
             .agg(F.min("First").alias("First"), F.max("Last").alias("Last"), F.sum("Revenue").alias("Revenue")))
    added = (fresh.join(before, ["CustomerId", "OrderId"], "left").groupBy("CustomerId")
             .agg(F.min("First").alias("FirstOrderDate"), F.max("Last").alias("LastOrderDate"),
                  F.count_if(F.col("_known").isNull()).alias("TotalOrders"), F.sum("Revenue").alias("TotalRevenue")))
    merged = (values.select(added.columns).unionByName(added).groupBy("CustomerId")
              .agg(F.min("FirstOrderDate").alias("FirstOrderDate"), F.max("LastOrderDate").alias("LastOrderDate"),
                   F.sum("TotalOrders").alias("TotalOrders"), F.sum("TotalRevenue").alias("TotalRevenue")))
    return gold.with_customer_ratios(merged, as_of)


def order_mix(fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Orders per day and set of categories (sorted; products without a category add none)."""
    lines = (fact.select("DateKey", "ProductKey", "OrderId")
             .join(dim_product.select("ProductKey", "Category"), "ProductKey")
             .join(dim_date.select("DateKey", "Date"), "DateKey"))
    return (lines.groupBy("Date", "OrderId").agg(F.sort_array(F.collect_set("Category")).alias("Categories"))
            .groupBy("Date", "Categories").agg(F.count(F.lit(1)).alias("OrderCount")))


def order_mix_incremental(mix: DataFrame, new_rows: DataFrame, fact: DataFrame, dim_date: DataFrame,
                          dim_product: DataFrame) -> DataFrame:
    return gold.recompute_days(mix, new_rows, fact, dim_date, dim_product, order_mix)


def touches(categories: Sequence[str]):
    """Whether a row of the mix touches one of the categories; an empty list asks for all orders."""
    return (F.arrays_overlap("Categories", F.array(*[F.lit(c) for c in categories])) if categories else F.lit(True))
