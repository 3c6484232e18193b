"""Request rules.  Each function returns one row per broken rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel import schemas as S


def _too_long(column: str, limit: int) -> Column:
    return F.length(F.coalesce(column, F.lit(""))) > limit


def _empty(column: str) -> Column:
    return F.trim(F.coalesce(column, F.lit(""))) == ""


def _broken(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return rows.select(key, F.explode(names).alias("Rule"))


def validate_orders(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Order requests: header and line rules; the lines fold to one row per request before they meet the header."""
    product, quantity = F.col("ProductId"), F.col("Quantity")
    folded = lines.groupBy("RequestId").agg(
        F.count(F.lit(1)).alias("Items"), F.count_if(product <= 0).alias("BadProduct"),
        F.count_if(quantity <= 0).alias("LowQuantity"), F.count_if(quantity > 10000).alias("HighQuantity"))
    rows = headers.join(folded, "RequestId", "left")
    items = F.coalesce("Items", F.lit(0))
    return _broken(rows, "RequestId", {
        "CustomerId must be greater than 0": F.coalesce("CustomerId", F.lit(0)) <= 0,
        "Order must contain at least 1 item": items == 0,
        "An order cannot contain more than 100 items": items > 100,
        "ProductId must be greater than 0": F.col("BadProduct") > 0,
        "Quantity must be greater than 0": F.col("LowQuantity") > 0,
        "Quantity per line cannot exceed 10000": F.col("HighQuantity") > 0,
        "ShipFullName is too long": _too_long("ShipFullName", 200),
        "ShipPhone is too long": _too_long("ShipPhone", 40),
        "ShipAddress is too long": _too_long("ShipAddress", 500),
        "Note is too long": _too_long("Note", 1000),
        "PaymentMethod is unknown": ~F.col("PaymentMethod").isin(*S.PAYMENT_METHOD)})


def validate_products(rows: DataFrame, update: bool = False) -> DataFrame:
    """Product drafts; an update carries no sku."""
    rules = {} if update else {"Sku is empty": _empty("Sku"), "Sku is too long": _too_long("Sku", 50)}
    rules |= {"Name is empty": _empty("Name"), "Name is too long": _too_long("Name", 300),
              "Category is empty": _empty("Category"), "Category is too long": _too_long("Category", 100),
              "Brand is too long": _too_long("Brand", 100), "Price is negative": F.col("Price") < 0,
              "StockQuantity is negative": F.col("StockQuantity") < 0}
    return _broken(rows, "ProductId", rules)


def normal_email(column: str) -> Column:
    return F.lower(F.trim(column))


def validate_customers(rows: DataFrame) -> DataFrame:
    """Registrations: names, lengths and an e-mail that has exactly one @ with text on both sides."""
    email = F.col("Email")
    return _broken(rows, "CustomerId", {
        "FullName is empty": _empty("FullName"), "FullName is too long": _too_long("FullName", 200),
        "Email is empty": _empty("Email"), "Email is not an address": ~email.rlike("^[^@]+@[^@]+$"),  # a missing one is only "empty"
        "Email is too long": _too_long("Email", 200), "Phone is too long": _too_long("Phone", 30),
        "City is too long": _too_long("City", 100)})
