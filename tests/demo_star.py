"""The demo star at its published size, made by remainder arithmetic: the fixture behind the golden numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.functions.scalars import date_key
from cartwheel.operators import adhoc

# ---- fixed values: stores and products of the demo star ---------------------------------------------------------------
STORES = [
    (1, "Bubble House Hoan Kiem", "Hà Nội", "Hoàn Kiếm", "2022-03-01"),
    (2, "Bubble House Cau Giay", "Hà Nội", "Cầu Giấy", "2022-09-15"),
    (3, "Bubble House District 1", "Hồ Chí Minh", "Quận 1", "2021-11-20"),
    (4, "Bubble House Thu Duc", "Hồ Chí Minh", "Thủ Đức", "2023-01-10"),
    (5, "Bubble House Hai Chau", "Đà Nẵng", "Hải Châu", "2023-05-05"),
    (6, "Bubble House Le Chan", "Hải Phòng", "Lê Chân", "2023-08-12"),
]
PRODUCTS = [
    (1, "Classic Milk Tea", "Milk Tea", "M", 45000), (2, "Classic Milk Tea", "Milk Tea", "L", 55000),
    (3, "Brown Sugar Boba", "Milk Tea", "M", 55000), (4, "Brown Sugar Boba", "Milk Tea", "L", 65000),
    (5, "Taro Milk Tea", "Milk Tea", "M", 50000), (6, "Matcha Milk Tea", "Milk Tea", "M", 52000),
    (7, "Peach Tea", "Fruit Tea", "M", 48000), (8, "Peach Tea", "Fruit Tea", "L", 58000),
    (9, "Lychee Tea", "Fruit Tea", "M", 48000), (10, "Passion Fruit Tea", "Fruit Tea", "M", 50000),
    (11, "Milk Coffee", "Coffee", "M", 40000), (12, "Americano", "Coffee", "M", 42000),
    (13, "Latte", "Coffee", "M", 50000), (14, "Mango Smoothie", "Smoothie", "M", 55000),
    (15, "Strawberry Smoothie", "Smoothie", "M", 55000), (16, "Pearl (Boba) Topping", "Topping", "NA", 8000),
    (17, "Cheese Foam Topping", "Topping", "NA", 12000), (18, "Pudding Topping", "Topping", "NA", 10000),
]
STAR_CUSTOMERS = 300
CITIES = {0: "Hà Nội", 1: "Hồ Chí Minh", 2: "Đà Nẵng", 3: "Hải Phòng"}


def star_stores(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STORES, "StoreKey int, StoreName string, City string, District string, Opened string")


def star_products(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(PRODUCTS, "ProductKey int, ProductName string, Category string, Size string, P int")
    return rows.withColumn("BasePrice", F.col("P").cast("decimal(10,2)")).drop("P")


def star_customers(keys: DataFrame) -> DataFrame:
    """Attributes of each customer number ``k`` by its remainders."""
    k = F.col("k")
    rest = k % 10
    city = F
    for number, name in CITIES.items():
        city = city.when(k % 4 == number, F.lit(name))
    tier = F.when(rest == 0, F.lit("Gold")).when(rest.isin(1, 2, 3), F.lit("Silver")).otherwise(F.lit("Bronze"))
    return keys.select(k.cast("int").alias("CustomerKey"), F.concat(F.lit("Customer "), k.cast("string")).alias(
        "CustomerName"), F.when(k % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("Gender"),
        tier.alias("MembershipTier"), city.otherwise(F.lit(None).cast("string")).alias("City"),
        F.date_add(F.lit("2023-01-01").cast("date"), ((k * 7) % 900).cast("int")).alias("JoinedDate"))


def star_fact(lines: DataFrame, products: DataFrame, customers: int | None = STAR_CUSTOMERS) -> DataFrame:
    """Sales lines by remainder arithmetic from line number ``n`` and ``OrderId``.

    With ``customers=None`` the lines bring their own ``CustomerKey``.  The 18 products are broadcast.
    """
    n, order = F.col("n"), F.col("OrderId")
    days = (adhoc.STAR_END - adhoc.STAR_START).days + 1
    who = F.col("CustomerKey") if customers is None else (1 + (order * 13) % customers)
    moment = F.date_add(F.lit(adhoc.STAR_START.isoformat()).cast("date"), ((order * 11) % days).cast("int"))
    rows = lines.select(
        n.alias("OrderItemKey"), "OrderId", date_key(moment).alias("DateKey"),
        (1 + (order * 5) % len(STORES)).cast("int").alias("StoreKey"),
        (1 + (n * 7) % len(PRODUCTS)).cast("int").alias("ProductKey"), who.cast("int").alias("CustomerKey"),
        (1 + n % 3).cast("int").alias("Quantity"))
    price, pay = F.col("BasePrice"), F.col("OrderId") % 3
    gross = price * F.col("Quantity")
    discount = F.when(F.col("OrderId") % 7 == 0, F.round(gross * F.lit("0.10").cast("decimal(3,2)"), 0)).otherwise(
        F.lit(0)).cast("decimal(12,2)")
    method = F.when(pay == 0, F.lit("Cash")).when(pay == 1, F.lit("Card")).otherwise(F.lit("EWallet"))
    return (rows.join(F.broadcast(products.select("ProductKey", "BasePrice")), "ProductKey")
            .select("OrderItemKey", "OrderId", "DateKey", "StoreKey", "ProductKey", "CustomerKey", "Quantity",
                    price.alias("UnitPrice"), discount.alias("DiscountAmount"),
                    (gross - discount).cast("decimal(12,2)").alias("LineTotal"), method.alias("PaymentMethod")))


def star_from_range(spark: SparkSession, lines: int = 12000) -> dict[str, DataFrame]:
    """The demo star at its published size: three lines an order."""
    n = spark.range(1, lines + 1).select(F.col("id").alias("n"), (F.floor((F.col("id") - 1) / 3) + 1).alias("OrderId"))
    products = star_products(spark)
    keys = spark.range(1, STAR_CUSTOMERS + 1).select(F.col("id").alias("k"))
    return {"DimStore": star_stores(spark), "DimProduct": products, "DimCustomer": star_customers(keys),
            "DimDate": adhoc.star_dates(spark), "FactOrderItem": star_fact(n, products)}
