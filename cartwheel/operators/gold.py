"""Gold aggregates over the star and over the current orders."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel import schemas as S
from cartwheel.functions.scalars import average, day, label


def daily_sales_by_category(fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Per (day, category): distinct orders, lines, revenue, average order.

    The distinct count groups by (day, category, order) first, so a hot category is spread over its orders.
    """
    lines = (fact.select("DateKey", "ProductKey", "OrderId", "LineTotal")
             .join(dim_product.select("ProductKey", "Category"), "ProductKey")
             .join(dim_date.select("DateKey", "Date"), "DateKey"))
    return (lines.groupBy("Date", "Category")
            .agg(F.countDistinct("OrderId").alias("OrderCount"), F.count(F.lit(1)).alias("ItemCount"),
                 F.sum("LineTotal").alias("TotalRevenue"))
            .withColumn("AvgOrderValue", average(F.col("TotalRevenue"), F.col("OrderCount"))))


def monthly_top_products(fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                         top: int = S.TOP_PER_MONTH) -> DataFrame:
    """Best products of each month by revenue.

    The fact shrinks to (month, product version) before the products are joined, and Spark keeps only ``top`` rows
    per month in each task before the months are shuffled.  Ties go to the smaller product id.
    """
    months = fact.select("DateKey", "ProductKey", "Quantity", "LineTotal").join(
        dim_date.select("DateKey", "Year", "Month"), "DateKey")
    versions = months.groupBy("Year", "Month", "ProductKey").agg(F.sum("Quantity").alias("Quantity"),
                                                                 F.sum("LineTotal").alias("Revenue"))
    return best_of_months(versions, dim_product, top)


def best_of_months(versions: DataFrame, dim_product: DataFrame, top: int) -> DataFrame:
    """The lists from rows per (month, product version), which may come in parts.

    A product is listed once for every sku, name and category it had in a month.  These are numbered within the product,
    so that numbers are shuffled with the months, and the texts are looked up for the rows of the lists only.
    """
    texts = F.dense_rank().over(Window.partitionBy("ProductId").orderBy("Name", "Sku", "Category"))
    known = dim_product.select("ProductKey", "ProductId", "Sku", F.col("Name").alias("ProductName"), "Category",
                               texts.alias("_texts"))
    monthly = (versions.join(known.select("ProductKey", "ProductId", "_texts"), "ProductKey")
               .groupBy("Year", "Month", "ProductId", "_texts")
               .agg(F.sum("Quantity").alias("TotalQuantity"), F.sum("Revenue").alias("TotalRevenue")))
    rank = F.row_number().over(Window.partitionBy("Year", "Month").orderBy(F.desc("TotalRevenue"), "ProductId", "_texts"))
    best = F.broadcast(monthly.withColumn("RankInMonth", rank).where(F.col("RankInMonth") <= top)).alias("b")
    same = F.col("b.ProductId").eqNullSafe(F.col("k.ProductId")) & (F.col("b._texts") == F.col("k._texts"))
    # versions of a product may share their texts; a list has one row a rank
    return (known.alias("k").join(best, same).dropDuplicates(["Year", "Month", "RankInMonth"])
            .select("Year", "Month", "k.ProductId", "Sku", "ProductName", "Category", "TotalQuantity", "TotalRevenue",
                    "RankInMonth"))


def customer_lifetime_value(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame,
                            as_of: datetime) -> DataFrame:
    """Per customer over all its versions.  Lines fold into orders before the customer is looked up."""
    orders = order_values(fact, dim_date).join(dim_customer.select("CustomerKey", "CustomerId"), "CustomerKey")
    return with_customer_ratios(orders.groupBy("CustomerId").agg(
        F.min("First").alias("FirstOrderDate"), F.max("Last").alias("LastOrderDate"),
        F.countDistinct("OrderId").alias("TotalOrders"), F.sum("Revenue").alias("TotalRevenue")), as_of)


def order_values(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (fact.join(dim_date.select("DateKey", "Date"), "DateKey").groupBy("CustomerKey", "OrderId")
            .agg(F.min("Date").alias("First"), F.max("Date").alias("Last"), F.sum("LineTotal").alias("Revenue")))


def with_customer_ratios(values: DataFrame, as_of: datetime) -> DataFrame:
    return (values.withColumn("AvgOrderValue", average(F.col("TotalRevenue"), F.col("TotalOrders")))
            .withColumn("DaysSinceLastOrder", F.datediff(day(as_of.date()), F.col("LastOrderDate"))))


def sales_by_payment_method(orders: DataFrame) -> DataFrame:
    """Per method from the current orders; refunded orders count in the gross figures only."""
    paid = F.col("PaymentStatus") == S.PAY_PAID
    return (orders.groupBy("PaymentMethod")
            .agg(F.count(F.lit(1)).alias("OrderCount"), F.count_if(paid).alias("PaidOrderCount"),
                 F.sum("TotalAmount").alias("TotalRevenue"),
                 F.sum(F.when(paid, F.col("TotalAmount")).otherwise(F.lit(0).cast(S.MONEY))).alias("PaidRevenue"))
            .withColumn("MethodName", label(F.col("PaymentMethod"), S.PAYMENT_METHOD)))


def order_funnel(orders: DataFrame) -> DataFrame:
    """Six stages from one pass over the orders."""
    status = F.col("Status")
    stages = [("Placed", F.lit(True)), ("Paid", F.col("PaymentStatus") == S.PAY_PAID),
              ("Confirmed", status.isin(S.CONFIRMED, S.SHIPPED, S.DELIVERED)),
              ("Shipped", status.isin(S.SHIPPED, S.DELIVERED)), ("Delivered", status == S.DELIVERED),
              ("Cancelled", status == S.CANCELLED)]
    counts = orders.agg(*[F.count_if(test).alias(name) for name, test in stages])
    rows = F.array(*[F.struct(F.lit(name).alias("Stage"), F.lit(nr).alias("StageOrder"),
                              F.col(name).alias("OrderCount")) for nr, (name, _) in enumerate(stages, 1)])
    return counts.select(F.inline(rows))


def _inventory(units: DataFrame, products: DataFrame) -> DataFrame:
    return (products.join(units, "ProductId", "left")
            .select("ProductId", "Sku", F.col("Name").alias("ProductName"), "Category",
                    F.col("StockQuantity").alias("CurrentStock"),
                    F.coalesce("UnitsSold", F.lit(0).cast("long")).alias("UnitsSold"),
                    (F.col("StockQuantity") < S.LOW_STOCK).alias("LowStock")))


def product_inventory(fact: DataFrame, dim_product: DataFrame, products: DataFrame,
                      all_versions: bool = False) -> DataFrame:
    """Stock and units sold of every product.

    Units booked under an old product version are left out, as published; ``all_versions`` counts them.
    """
    per_version = fact.groupBy("ProductKey").agg(F.sum("Quantity").alias("Units"))
    versions = dim_product if all_versions else dim_product.where("IsCurrent")
    units = (per_version.join(versions.select("ProductKey", "ProductId"), "ProductKey")
             .groupBy("ProductId").agg(F.sum("Units").alias("UnitsSold")))
    return _inventory(units, products)


def daily_sales_incremental(gold: DataFrame, new_rows: DataFrame, fact: DataFrame, dim_date: DataFrame,
                            dim_product: DataFrame) -> DataFrame:
    """The daily table after a batch, recomputing only the days the batch touches."""
    return recompute_days(gold, new_rows, fact, dim_date, dim_product, daily_sales_by_category)


def recompute_days(table: DataFrame, new_rows: DataFrame, fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                   build: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """A table by Date after a batch: ``build`` makes the touched days anew, the others stay.

    ``new_rows`` and ``fact`` are the batch and the whole fact including it.  The touched days are at most the days
    of the calendar, so they are broadcast; on a fact table by month they also prune the months to read.
    """
    month = ["MonthKey"] if "MonthKey" in fact.columns and "MonthKey" in new_rows.columns else []
    touched = dim_date.join(new_rows.select("DateKey", *month).distinct(), "DateKey").select("Date", "DateKey", *month)
    wanted = F.broadcast(touched.drop("Date"))
    redone = build(fact.join(wanted, ["DateKey", *month], "left_semi"), dim_date, dim_product)
    days = F.broadcast(touched.select("Date"))
    return table.join(days, "Date", "left_anti").select(redone.columns).unionByName(redone)
