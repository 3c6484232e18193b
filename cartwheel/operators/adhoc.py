"""Ad-hoc work: the milk-tea star, canned questions, result comparison, scoreboards and the ask log."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cartwheel import schemas as S
from cartwheel.functions.scalars import date_key, percent, percent_half_even, whole_average
from cartwheel.functions.skew import previous_value, time_chunk
from cartwheel.operators import dims

#: known question (normal form) -> the registered query that answers it
CANNED = {
    "what was total revenue in 2024?": "fnb_revenue_2024",
    "top 5 best-selling products by quantity": "fnb_top5_products",
    "doanh thu theo thành phố trong năm 2025": "fnb_city_2025",
    "how many orders were placed in 2025?": "fnb_orders_2025",
    "revenue by payment method": "fnb_by_method",
    "revenue by membership tier in 2024": "fnb_by_tier_2024",
    "monthly revenue in 2025": "fnb_monthly_2025",
    "top 3 stores by revenue": "fnb_top3_stores",
}
FALLBACK = "fnb_top_price"
STAR_START, STAR_END = date(2024, 1, 1), date(2025, 12, 31)


def star_dates(spark: SparkSession) -> DataFrame:
    return dims.date_dim(spark, STAR_START, STAR_END, first_day="monday")


def _year(star: Mapping[str, DataFrame], year: int) -> DataFrame:
    """Facts of a year.  The calendar has a fixed 731 rows, so it is broadcast."""
    days = star["DimDate"].where(F.col("Year") == year).select("DateKey", "Month", "MonthName")
    return star["FactOrderItem"].join(F.broadcast(days), "DateKey")


def star_revenue(star: Mapping[str, DataFrame], year: int) -> DataFrame:
    return _year(star, year).agg(F.sum("LineTotal").alias("TotalRevenue"))


def _top(rows: DataFrame, value: str, key: str, size: int) -> DataFrame:
    return rows.orderBy(F.desc(value), key).limit(size)


def star_top_products(star: Mapping[str, DataFrame], size: int = 5) -> DataFrame:
    """Units fold to product keys before names are looked up."""
    units = star["FactOrderItem"].groupBy("ProductKey").agg(F.sum("Quantity").alias("u"))
    named = units.join(star["DimProduct"].select("ProductKey", "ProductName"), "ProductKey")
    return _top(named.groupBy("ProductName").agg(F.sum("u").alias("UnitsSold")), "UnitsSold", "ProductName", size)


def star_revenue_by_city(star: Mapping[str, DataFrame], year: int) -> DataFrame:
    per_store = _year(star, year).groupBy("StoreKey").agg(F.sum("LineTotal").alias("r"))
    return (per_store.join(star["DimStore"].select("StoreKey", "City"), "StoreKey")
            .groupBy("City").agg(F.sum("r").alias("Revenue")))


def star_orders(star: Mapping[str, DataFrame], year: int) -> DataFrame:
    return _year(star, year).agg(F.countDistinct("OrderId").alias("OrderCount"))


def star_by_method(star: Mapping[str, DataFrame]) -> DataFrame:
    return star["FactOrderItem"].groupBy("PaymentMethod").agg(F.sum("LineTotal").alias("Revenue"))


def star_by_tier(star: Mapping[str, DataFrame], year: int) -> DataFrame:
    per_customer = _year(star, year).groupBy("CustomerKey").agg(F.sum("LineTotal").alias("r"))
    return (per_customer.join(star["DimCustomer"].select("CustomerKey", "MembershipTier"), "CustomerKey")
            .groupBy("MembershipTier").agg(F.sum("r").alias("Revenue")))


def star_monthly(star: Mapping[str, DataFrame], year: int) -> DataFrame:
    return (_year(star, year).groupBy(F.col("Month").alias("MonthNum"), "MonthName")
            .agg(F.sum("LineTotal").alias("Revenue")))


def star_top_stores(star: Mapping[str, DataFrame], size: int = 3) -> DataFrame:
    per_store = star["FactOrderItem"].groupBy("StoreKey").agg(F.sum("LineTotal").alias("r"))
    named = per_store.join(star["DimStore"].select("StoreKey", "StoreName"), "StoreKey")
    return _top(named.groupBy("StoreName").agg(F.sum("r").alias("Revenue")), "Revenue", "StoreName", size)


def top_price(products: DataFrame, price: str, key: str, size: int = 10) -> DataFrame:
    """The fallback answer: the most expensive products."""
    return _top(products, price, key, size)


# ---------------------------------------------------------------- questions
def normal_question(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(text, r"^\s+|\s+$", "")), r"\s+", " ")


def canned_match(questions: DataFrame, canned: Mapping[str, str], fallback: str) -> DataFrame:
    """Answer id per question: the canned one with the same normal form, else the fallback.

    The canned list is a handful of literals kept inside the expression, so no join is needed.
    """
    table = F.create_map(*[F.lit(x) for pair in canned.items() for x in pair])
    key = normal_question(F.col("Question"))
    found = F.try_element_at(table, key)
    return questions.select("AskId", key.alias("Normal"), F.coalesce(found, F.lit(fallback)).alias("Answer"),
                            found.isNotNull().alias("Matched"))


def _canonical(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.NumericType):
        wide = column.cast("decimal(38,10)").cast("string")
        text = F.regexp_replace(wide, r"\.?0+$", "")
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        text = F.date_format(column.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    elif isinstance(field.dataType, T.BooleanType):
        text = F.initcap(column.cast("string"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("(null)"))


def canonical_rows(frame: DataFrame) -> DataFrame:
    """Every row as one text: nulls marked, numbers to ten decimals without trailing zeros, times to seconds."""
    return frame.select(F.concat_ws("␟", *[_canonical(f) for f in frame.schema.fields]).alias("Row"))


def result_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two results has, counted; empty when they are the same multiset of rows.

    Column names and row order do not matter.  Results of different width differ in every row.
    """
    count = F.sum("n").cast("long")
    both = (canonical_rows(left).withColumn("n", F.lit(1))
            .unionByName(canonical_rows(right).withColumn("n", F.lit(-1))))
    if len(left.columns) != len(right.columns):
        both = both.withColumn("Row", F.concat(F.col("n").cast("string"), F.lit("␟"), "Row"))
    rows = both.groupBy("Row").agg(count.alias("n")).where("n <> 0")
    return rows.select("Row", F.when(F.col("n") > 0, F.lit("left")).otherwise(F.lit("right")).alias("OnlyIn"),
                       F.abs("n").alias("Copies"))


# ---------------------------------------------------------------- scoreboards and log metrics
def eval_scoreboard(results: DataFrame) -> DataFrame:
    """Passed / total and rounded mean latency per difficulty and overall."""
    rows = results.rollup("Difficulty").agg(
        F.count_if("Passed").alias("Passed"), F.count(F.lit(1)).alias("Total"),
        F.sum("LatencyMs").alias("_sum"), F.count("LatencyMs").alias("_n"), F.grouping("Difficulty").alias("_all"))
    name = F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.col("Difficulty"))
    mean = F.round(whole_average(F.col("_sum"), F.col("_n")), 0).cast("long")
    return rows.select(name.alias("Difficulty"), "Passed", "Total",
                       percent(F.col("Passed"), F.col("Total")).alias("AccuracyPct"), mean.alias("AvgLatencyMs"))


def safety_scoreboard(cases: DataFrame) -> DataFrame:
    """Cases with what was expected (reject / allow) and whether the guard rejected them."""
    bad, rejected = F.lower("Expect") == "reject", F.col("Rejected")
    counts = cases.agg(F.count_if(bad).alias("Malicious"), F.count_if(bad & rejected).alias("Blocked"),
                       F.count_if(~bad).alias("Benign"), F.count_if(~bad & ~rejected).alias("Allowed"),
                       F.count_if(~bad & rejected).alias("FalseRefusals"))
    return (counts.withColumn("BlockedPct", percent(F.col("Blocked"), F.col("Malicious")))
            .withColumn("Clean", (F.col("Blocked") == F.col("Malicious")) & (F.col("FalseRefusals") == 0)))


def ask_metrics(log: DataFrame) -> DataFrame:
    """Totals, rates and mean latency; cache hits and errors have no latency, the mean is an integer division."""
    status = F.col("Status")
    timed = status.isin("Answered", "Refused")
    counts = log.agg(F.count(F.lit(1)).alias("TotalQuestions"), F.count_if(status == "Answered").alias("Answered"),
                     F.count_if(status == "Refused").alias("Refused"), F.count_if(status == "Error").alias("Errors"),
                     F.count_if(status == "CacheHit").alias("CacheHits"),
                     F.sum(F.when(timed, F.col("LatencyMs"))).alias("_sum"), F.count_if(timed).alias("_n"))
    mean = F.floor(whole_average(F.col("_sum"), F.col("_n"))).cast("long")
    return (counts.withColumn("RefusalRatePct", percent_half_even(F.col("Refused"), F.col("TotalQuestions")))
            .withColumn("CacheHitRatePct", percent_half_even(F.col("CacheHits"), F.col("TotalQuestions")))
            .withColumn("AvgLatencyMs", mean).drop("_sum", "_n"))


def repeat_questions(log: DataFrame, seconds: int = S.ANSWER_TTL_SECONDS) -> DataFrame:
    """Marks a question asked before with the same text no more than ``seconds`` ago.

    Questions that ended in an error leave no answer behind and are not counted as a source.  The question before is
    looked up minute by minute, so one text that everybody asks is cut into parts.
    """
    asked = log.withColumn("_key", F.lower(F.trim("Question")))
    seen = previous_value(asked.where("Status <> 'Error'"), ["_key"], ["AskedAt", "AskId"],
                          time_chunk("AskedAt", "AskId"), "AskedAt", "Before")
    repeats = F.coalesce(F.col("AskedAt") <= F.col("Before") + F.make_dt_interval(secs=F.lit(seconds)), F.lit(False))
    return seen.select("AskId", "_key", F.col("Before").isNotNull().alias("AskedBefore"), repeats.alias("Repeat")
                       ).withColumnRenamed("_key", "QuestionKey")
