"""Enumerations, thresholds and table schemas."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

# ---- fixed values: enum codes ------------------------------------------------------------------------------------
PENDING, CONFIRMED, SHIPPED, DELIVERED, CANCELLED = 1, 2, 3, 4, 5
ORDER_STATUS = {PENDING: "Pending", CONFIRMED: "Confirmed", SHIPPED: "Shipped", DELIVERED: "Delivered",
                CANCELLED: "Cancelled"}
COD, VNPAY, MOMO = 1, 2, 3
PAYMENT_METHOD = {COD: "COD", VNPAY: "VNPay", MOMO: "MoMo"}
PAY_UNPAID, PAY_PENDING, PAY_PAID, PAY_FAILED, PAY_REFUNDED = 1, 2, 3, 4, 5
PAYMENT_STATUS = {PAY_UNPAID: "Unpaid", PAY_PENDING: "Pending", PAY_PAID: "Paid", PAY_FAILED: "Failed",
                  PAY_REFUNDED: "Refunded"}
#: allowed status changes
TRANSITIONS = {PENDING: (CONFIRMED, CANCELLED), CONFIRMED: (SHIPPED, CANCELLED), SHIPPED: (DELIVERED,),
               DELIVERED: (), CANCELLED: ()}

# ---- fixed values: thresholds ------------------------------------------------------------------------------------
LOW_STOCK = 20
TOP_PER_MONTH = 50
OUTBOX_BATCH = 50
OUTBOX_MAX_ATTEMPTS = 5
ROW_CAP = 1000
STALE_MINUTES = 90
ANSWER_TTL_SECONDS = 600
SHIPPING_FEE, FREE_SHIPPING_FROM, VAT_RATE = "30000", "500000", "0.08"
PIPELINE = "SalesOrderItem"

# ---- clock values used by the registered queries ------------------------------------------------------------------
AS_OF = datetime(2001, 12, 31)
FIRST_LOAD = datetime(1995, 1, 1)
SECOND_LOAD = datetime(1998, 7, 1)

MONEY = T.DecimalType(18, 2)
#: a sum of money, as Spark widens it
WIDE_MONEY = T.DecimalType(28, 2)

ORDER_ITEMS = T.StructType([
    T.StructField("OrderItemId", T.LongType()), T.StructField("OrderId", T.LongType()),
    T.StructField("ProductId", T.LongType()), T.StructField("Quantity", T.IntegerType()),
    T.StructField("UnitPrice", MONEY), T.StructField("LineTotal", MONEY)])

BRONZE = ("OrderItemId bigint, OrderId bigint, CustomerId bigint, ProductId bigint, OrderDate timestamp_ntz, Quantity int, "
          "UnitPrice decimal(18,2), LineTotal decimal(18,2), IngestedAt timestamp_ntz, SourceSystem string")

#: columns of the star and gold tables.  Sums keep the wider type Spark gives them: a total over very many lines
#: does not fit 18 digits.
OLAP = {
    "dim_date": "DateKey int, Date date, Year int, Quarter int, Month int, MonthName string, Day int, DayOfWeek int, "
                "IsWeekend boolean",
    "dim_customer": "CustomerKey bigint, CustomerId bigint, FullName string, Email string, City string, "
                    "ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsCurrent boolean, Version int, RowHash string",
    "dim_product": "ProductKey bigint, ProductId bigint, Sku string, Name string, Category string, Brand string, "
                   "ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsCurrent boolean, Version int, RowHash string",
    "fact": "DateKey int, CustomerKey bigint, ProductKey bigint, OrderId bigint, OrderItemId bigint, Quantity int, "
            "UnitPrice decimal(18,2), LineTotal decimal(18,2), EtlLoadedAt timestamp_ntz",
    "gold_daily": "Date date, Category string, OrderCount bigint, ItemCount bigint, TotalRevenue decimal(28,2), "
                  "AvgOrderValue decimal(18,2)",
    "gold_monthly": "Year int, Month int, ProductId bigint, Sku string, ProductName string, Category string, "
                    "TotalQuantity bigint, TotalRevenue decimal(38,2), RankInMonth int",
    "gold_clv": "CustomerId bigint, FirstOrderDate date, LastOrderDate date, TotalOrders bigint, "
                "TotalRevenue decimal(38,2), AvgOrderValue decimal(18,2), DaysSinceLastOrder int",
    "gold_mix": "PaymentMethod int, OrderCount bigint, PaidOrderCount bigint, TotalRevenue decimal(28,2), "
                "PaidRevenue decimal(28,2), MethodName string",
    "gold_funnel": "Stage string, StageOrder int, OrderCount bigint",
    "gold_inventory": "ProductId bigint, Sku string, ProductName string, Category string, CurrentStock int, "
                      "UnitsSold bigint, LowStock boolean",
}

CALLBACKS = T.StructType([
    T.StructField("Seq", T.LongType()), T.StructField("Ref", T.StringType()),
    T.StructField("Amount", MONEY), T.StructField("SignatureValid", T.BooleanType()),
    T.StructField("Success", T.BooleanType())])

OUTBOX = T.StructType([
    T.StructField("OutboxId", T.LongType()), T.StructField("OrderId", T.LongType()),
    T.StructField("EventType", T.StringType()), T.StructField("Payload", T.StringType()),
    T.StructField("ProcessedAt", T.TimestampNTZType()), T.StructField("Attempts", T.IntegerType()),
    T.StructField("LastError", T.StringType())])

SCHEMA_DOCUMENT = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("defaultSchema", T.StringType()),
    T.StructField("maxRows", T.IntegerType()),
    T.StructField("tables", T.ArrayType(T.StructType([
        T.StructField("schema", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("grain", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
            T.StructField("description", T.StringType())])))]))),
    T.StructField("fewShot", T.ArrayType(T.StructType([
        T.StructField("question", T.StringType()), T.StructField("sql", T.StringType())])))])
