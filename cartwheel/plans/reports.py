"""Reports over the gold tables, and the same questions asked of silver and of the source tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.functions.scalars import day, narrow, percent
from cartwheel.operators.gold_state import touches


def _range(gold_daily: DataFrame, start: date, end: date) -> DataFrame:
    return gold_daily.where(F.col("Date").between(day(start), day(end)))


def sales_by_category(gold_daily: DataFrame, start: date, end: date) -> DataFrame:
    """Orders are summed over days and categories, so an order in two categories counts twice, as published."""
    return (_range(gold_daily, start, end).groupBy("Category")
            .agg(F.sum("OrderCount").alias("OrderCount"), F.sum("TotalRevenue").alias("TotalRevenue"))
            .orderBy(F.desc("TotalRevenue"), "Category"))


def sales_by_day(gold_daily: DataFrame, start: date, end: date) -> DataFrame:
    return (_range(gold_daily, start, end).groupBy(F.col("Date").alias("Day"))
            .agg(F.sum("OrderCount").alias("OrderCount"), F.sum("TotalRevenue").alias("TotalRevenue")).orderBy("Day"))


def top_products(gold_monthly: DataFrame, start: date, end: date, top: int = 10) -> DataFrame:
    """Whole months that the range touches, over the monthly best lists."""
    month = F.make_date("Year", "Month", F.lit(1))
    return (gold_monthly.where(month.between(day(start.replace(day=1)), day(end.replace(day=1))))
            .groupBy("ProductId").agg(F.max("Sku").alias("Sku"), F.max("ProductName").alias("Name"),
                                      F.sum("TotalQuantity").alias("TotalQuantity"),
                                      F.sum("TotalRevenue").alias("TotalRevenue"))
            .orderBy(F.desc("TotalRevenue"), "ProductId").limit(top))


def top_products_exact(product_months: DataFrame, dim_product: DataFrame, start: date, end: date,
                       top: int = 10) -> DataFrame:
    """The same months over every product sold, also those that miss the monthly lists."""
    low, high = (d.year * 100 + d.month for d in (start, end))
    versions = (product_months.where(F.col("MonthKey").between(low, high)).groupBy("ProductKey")
                .agg(F.sum("Quantity").alias("Quantity"), F.sum("LineTotal").alias("Revenue")))
    named = versions.join(dim_product.select("ProductKey", "ProductId", "Sku", "Name"), "ProductKey")
    return (named.groupBy("ProductId").agg(F.max("Sku").alias("Sku"), F.max("Name").alias("Name"),
                                           F.sum("Quantity").alias("TotalQuantity"),
                                           F.sum("Revenue").alias("TotalRevenue"))
            .orderBy(F.desc("TotalRevenue"), "ProductId").limit(top))


def payment_mix(gold_mix: DataFrame) -> DataFrame:
    return gold_mix.select("PaymentMethod", "MethodName", "OrderCount", "PaidOrderCount", "TotalRevenue",
                           "PaidRevenue").orderBy(F.desc("TotalRevenue"), "PaymentMethod")


def funnel(gold_funnel: DataFrame) -> DataFrame:
    return gold_funnel.select("Stage", "StageOrder", "OrderCount").orderBy("StageOrder")


def low_stock(gold_inventory: DataFrame, limit: int = 50) -> DataFrame:
    return (gold_inventory.where("LowStock")
            .select("ProductId", "Sku", "ProductName", "Category", "CurrentStock", "UnitsSold", "LowStock")
            .orderBy("CurrentStock", "ProductId").limit(limit))


def kpi_tiles(by_category: DataFrame) -> DataFrame:
    """Tiles over the category report; the order total over-counts, see ``exact_orders``."""
    return by_category.agg(F.sum("TotalRevenue").alias("TotalRevenue"), F.sum("OrderCount").alias("TotalOrders"),
                           F.count("Category").alias("ActiveCategories"))


def _fact_range(fact: DataFrame, start: date, end: date) -> DataFrame:
    """Facts of a day range; the month partition is pruned when the fact is read from its table."""
    low, high = (d.year * 10000 + d.month * 100 + d.day for d in (start, end))
    rows = fact.where(F.col("DateKey").between(low, high))
    return rows.where(F.col("MonthKey").between(low // 100, high // 100)) if "MonthKey" in fact.columns else rows


def exact_orders(fact: DataFrame, start: date, end: date) -> DataFrame:
    return _fact_range(fact, start, end).agg(F.countDistinct("OrderId").alias("OrderCount"))


def exact_orders_of(order_mix: DataFrame, start: date, end: date, categories: Sequence[str] = ()) -> DataFrame:
    """Distinct orders of a day range that touch one of the categories, without a look at the fact."""
    wanted = _range(order_mix, start, end).where(touches(categories))
    return wanted.agg(F.coalesce(F.sum("OrderCount"), F.lit(0)).alias("OrderCount"))


def chart_by_day(by_day: DataFrame) -> DataFrame:
    """Revenue in whole millions, halves up, and orders."""
    return by_day.select("Day", F.floor(narrow(F.col("TotalRevenue")) / 1000000 + F.lit("0.5").cast("decimal(2,1)"))
                         .cast("long").alias("RevenueMillions"), F.col("OrderCount").alias("Orders"))


def revenue_share(rows: DataFrame, name: str) -> DataFrame:
    """Share of each row in the total; the window spans the few rows of a report, never facts."""
    total = F.sum("TotalRevenue").over(Window.partitionBy())
    return rows.select(name, "TotalRevenue", percent(F.col("TotalRevenue"), total).alias("SharePct"))


def paid_ratio(gold_mix: DataFrame) -> DataFrame:
    return gold_mix.select("MethodName", F.concat_ws("/", F.col("PaidOrderCount").cast("string"),
                                                     F.col("OrderCount").cast("string")).alias("PaidLabel"),
                           percent(F.col("PaidOrderCount"), F.col("OrderCount")).alias("PaidPct"))


def silver_sales_by_category(fact: DataFrame, dim_product: DataFrame, start: date, end: date) -> DataFrame:
    """The category question on the fact: facts fold to products before the categories are looked up."""
    per_product = (_fact_range(fact, start, end).groupBy("ProductKey")
                   .agg(F.sum("LineTotal").alias("r"), F.count(F.lit(1)).alias("n")))
    return (per_product.join(dim_product.select("ProductKey", "Category"), "ProductKey").groupBy("Category")
            .agg(F.sum("n").alias("ItemCount"), F.sum("r").alias("TotalRevenue"))
            .orderBy(F.desc("TotalRevenue"), "Category"))


def oltp_sales_by_category(items: DataFrame, orders: DataFrame, products: DataFrame, last_day: date,
                           days: int = 90) -> DataFrame:
    """The same question as a three-way join of the source tables over the last days.

    The date filter cuts the orders before the join, and lines fold to products before the categories are looked up.
    """
    first = F.date_sub(day(last_day), days)
    recent = orders.where((F.col("OrderDate") >= first) & (F.col("OrderDate") < F.date_add(day(last_day), 1)))
    per_product = (items.select("OrderId", "ProductId", "LineTotal").join(recent.select("OrderId"), "OrderId")
                   .groupBy("ProductId").agg(F.sum("LineTotal").alias("r"), F.count(F.lit(1)).alias("n")))
    return (per_product.join(products.select("ProductId", "Category"), "ProductId").groupBy("Category")
            .agg(F.sum("n").alias("ItemCount"), F.sum("r").alias("TotalRevenue"))
            .orderBy(F.desc("TotalRevenue"), "Category"))
