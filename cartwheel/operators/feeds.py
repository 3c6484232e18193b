"""Bulk feeds: row checks, duplicate rule, accepted rows and an error list.

A feed is a frame of strings with a ``RowNo`` (the header is row 1).  Checks run in a fixed order and the first one
that fails names the row's error.  Only rows that pass every earlier check can claim an email or a sku.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel import schemas as S
from cartwheel.functions.scalars import blank_to_null, ts
from cartwheel.functions.skew import first_claims


BLANKS = " \t\r\n\u00a0"

# ---- fixed values: error texts ---------------------------------------------------------------------------------------
REQUIRED = "{} is required"
DUPLICATE = "Duplicate {}: "
BAD_PRICE = "Price must be > 0"
BAD_QUANTITY = "Quantity must be > 0"
NO_CUSTOMER = "Customer not found by email: "
NO_PRODUCT = "Product not found by SKU: "
#: our own text for a cell that holds no number
NOT_A_NUMBER = "{} is not a number"


class Loaded(NamedTuple):
    accepted: DataFrame
    errors: DataFrame


def trimmed(feed: DataFrame) -> DataFrame:
    """Cells without surrounding blanks, missing cells as ''; rows whose cells are all empty are dropped.

    A cell that holds only blanks is not empty: its row is used, and then fails a check.
    """
    cells = [c for c in feed.columns if c != "RowNo"]
    used = feed.where(F.concat_ws("", *cells) != "")
    return used.select("RowNo", *[F.coalesce(F.trim(c, F.lit(BLANKS)), F.lit("")).alias(c) for c in cells])


def _first_error(*checks: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(message)) for bad, message in checks], F.lit(None).cast("string"))


def _unique(rows: DataFrame, column: str, taken: DataFrame) -> DataFrame:
    """Adds the duplicate error: the first valid row owns the value, unless the table has it already.

    Rows that failed before claim nothing; they get a key of their own, not a shared null that would meet in one task.
    """
    low = F.lower(F.col(column))
    apart = F.concat(F.lit("\u0000"), F.col("RowNo").cast("string"))
    marked = rows.withColumn("_claim", F.when(F.col("Error").isNull(), low).otherwise(apart))
    owners = first_claims(marked.where("Error is null"), "_claim", "RowNo",
                          taken.select(low.alias("_claim")).where("_claim is not null"))
    message = F.concat(F.lit(DUPLICATE.format(column)), F.col(column))
    return (marked.join(owners, "_claim", "left")
            .withColumn("Error", F.coalesce("Error", F.when(F.col("Owner") != F.col("RowNo"), message)))
            .drop("_claim", "Owner"))


def _errors(rows: DataFrame) -> DataFrame:
    return rows.where("Error is not null").select("RowNo", F.col("Error").alias("Message"))


def load_customers(feed: DataFrame, existing: DataFrame) -> Loaded:
    rows = trimmed(feed)
    rows = rows.withColumn("Error", _first_error((F.col("FullName") == "", REQUIRED.format("FullName")),
                                                 (F.col("Email") == "", REQUIRED.format("Email"))))
    rows = _unique(rows, "Email", existing)
    accepted = rows.where("Error is null").select("RowNo", "FullName", "Email", blank_to_null(F.col("Phone"))
                                                  .alias("Phone"), blank_to_null(F.col("City")).alias("City"))
    return Loaded(accepted, _errors(rows))


def load_products(feed: DataFrame, existing: DataFrame) -> Loaded:
    """Numbers are read before any other check, so a bad number wins over a missing sku."""
    rows = (trimmed(feed).withColumn("_price", F.expr("try_cast(Price as decimal(28,10))"))
            .withColumn("_stock", F.expr("try_cast(StockQuantity as int)")))
    rows = rows.withColumn("Error", _first_error(
        (F.col("_price").isNull(), NOT_A_NUMBER.format("Price")),
        (F.col("_stock").isNull(), NOT_A_NUMBER.format("StockQuantity")),
        (F.col("Sku") == "", REQUIRED.format("Sku")), (F.col("Name") == "", REQUIRED.format("Name")),
        (F.col("Category") == "", REQUIRED.format("Category")), (F.col("_price") <= 0, BAD_PRICE)))
    rows = _unique(rows, "Sku", existing)
    accepted = rows.where("Error is null").select(
        "RowNo", "Sku", "Name", "Category", blank_to_null(F.col("Brand")).alias("Brand"),
        F.col("_price").cast(S.MONEY).alias("Price"), F.col("_stock").alias("StockQuantity"))
    return Loaded(accepted, _errors(rows))


def load_orders(feed: DataFrame, customers: DataFrame, products: DataFrame, as_of: datetime) -> Loaded:
    """Lines with the same ref form one order.

    The customer comes from the order's first line.  One unknown sku rejects the order, and every such line is
    reported, but only when the customer is known.  All per-order facts are mergeable aggregates, so an order with
    very many lines is combined before the shuffle.
    """
    rows = trimmed(feed).withColumn("_qty", F.expr("try_cast(Quantity as int)"))
    rows = rows.withColumn("Error", _first_error(
        (F.col("_qty").isNull(), NOT_A_NUMBER.format("Quantity")), (F.col("OrderRef") == "", REQUIRED.format("OrderRef")),
        (F.col("CustomerEmail") == "", REQUIRED.format("CustomerEmail")), (F.col("Sku") == "", REQUIRED.format("Sku")),
        (F.col("_qty") <= 0, BAD_QUANTITY)))
    prices = products.select(F.lower("Sku").alias("_sku"), "ProductId", "Price")
    lines = (rows.where("Error is null").withColumn("_sku", F.lower("Sku")).join(prices, "_sku", "left")
             .withColumn("LineTotal", (F.col("Price") * F.col("_qty")).cast(S.MONEY)))
    unknown = F.col("ProductId").isNull()
    refs = lines.groupBy("OrderRef").agg(
        F.min("RowNo").alias("FirstRow"), F.min_by("CustomerEmail", "RowNo").alias("Email"),
        F.count_if(unknown).alias("Unknown"), F.count(F.lit(1)).alias("Lines"),
        F.sum("LineTotal").alias("TotalAmount"))
    people = customers.select(F.lower("Email").alias("_email"), "CustomerId")
    refs = refs.withColumn("_email", F.lower("Email")).join(people, "_email", "left")
    lost = refs.where("CustomerId is null").select(
        F.col("FirstRow").alias("RowNo"), F.concat(F.lit(NO_CUSTOMER), "Email").alias("Message"))
    bad = (lines.where(unknown).select("OrderRef", "RowNo", "Sku")
           .join(refs.where("CustomerId is not null").select("OrderRef"), "OrderRef", "left_semi")
           .select("RowNo", F.concat(F.lit(NO_PRODUCT), "Sku").alias("Message")))
    stamp = as_of.strftime("%Y%m%d%H%M%S")
    accepted = refs.where("CustomerId is not null and Unknown = 0").select(
        "OrderRef", F.concat(F.lit(f"ORD-XLS-{stamp}-"), "OrderRef").alias("OrderNumber"), "CustomerId",
        ts(as_of).alias("OrderDate"), F.lit(S.PENDING).alias("Status"), "Lines", "TotalAmount")
    return Loaded(accepted, _errors(rows).unionByName(lost).unionByName(bad))


def feed_summary(kind: str, feed: DataFrame, loaded: Loaded) -> DataFrame:
    """Rows read, things accepted (orders, not lines, for an order feed) and errors reported."""
    tagged = [frame.select(F.lit(tag).alias("_tag")) for tag, frame in
              (("t", trimmed(feed)), ("a", loaded.accepted), ("e", loaded.errors))]
    every = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    tag = F.col("_tag")
    return every.agg(F.count_if(tag == "t").alias("TotalRows"), F.count_if(tag == "a").alias("SuccessCount"),
                     F.count_if(tag == "e").alias("ErrorCount")).withColumn("Feed", F.lit(kind))
