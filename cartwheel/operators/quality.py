"""Declarative data-quality tests over the star and the gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.functions.scalars import ts
from cartwheel.session import tidied

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class DqTest:
    """A number and the test it must pass.

    ``measure`` is one aggregate over ``table``: all such tests of a table share a single scan.  ``frame`` is for
    numbers that need a join or a grouping; it returns one row with one column.
    """
    name: str
    category: str
    severity: str
    expected: str
    passes: Callable[[Column], Column]
    table: str | None = None
    measure: Callable[[datetime], Column] | None = None
    frame: Callable[[Tables], DataFrame] | None = None


def _is_zero(value: Column) -> Column:
    return value == 0


def _is_positive(value: Column) -> Column:
    return value > 0


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)))


def _orphans(rows: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    """Rows whose key is in no dimension row; rows fold to one per key before the join, null keys included."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.join(dimension.select(key), key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)))


def _counts(test: Column) -> Callable[[datetime], Column]:
    return lambda as_of: F.count_if(test)


def _any_since(column: str, hours: int) -> Callable[[datetime], Column]:
    return lambda as_of: F.when(
        F.max(F.col(column)) > ts(as_of) - F.make_dt_interval(hours=F.lit(hours)), F.lit(1)).otherwise(F.lit(0))


# ---- fixed values: name, category, severity and expectation of the tests -----------------------------------------------
TESTS = [
    ("fact_no_duplicate_orderitemid", "Uniqueness", "Critical", "0 duplicate OrderItemIds in fact"),
    ("dim_customer_one_current_per_id", "Uniqueness", "Critical", "0 customers with >1 IsCurrent=1 row"),
    ("fact_customerkey_resolves", "Integrity", "Critical", "0 fact rows with orphan CustomerKey"),
    ("fact_productkey_resolves", "Integrity", "Critical", "0 fact rows with orphan ProductKey"),
    ("fact_datekey_resolves", "Integrity", "Critical", "0 fact rows with orphan DateKey"),
    ("fact_freshness_24h", "Freshness", "Warning", "ETL loaded fact in last 24h"),
    ("gold_freshness_2h", "Freshness", "Warning", "Gold layer refreshed in last 2h"),
    ("fact_row_count_nonzero", "Completeness", "Critical", ">0 rows in fact (sanity)"),
    ("dim_customer_count_nonzero", "Completeness", "Critical", ">0 customers in dim"),
    ("fact_no_negative_revenue", "Business", "Critical", "0 fact rows with LineTotal <= 0"),
    ("fact_no_zero_quantity", "Business", "Critical", "0 fact rows with Quantity <= 0"),
    ("fact_unitprice_lineTotal_consistency", "Business", "Warning",
     "0 fact rows where Quantity*UnitPrice ≠ LineTotal (rounded)"),
    ("inventory_no_negative_stock", "Business", "Critical", "0 products with CurrentStock < 0 (oversell guard)"),
    ("inventory_low_stock_watch", "Business", "Warning",
     "0 products below the low-stock threshold (informational)"),
    ("payment_paid_not_exceed_total", "Business", "Critical", "0 payment methods where PaidRevenue > TotalRevenue"),
]
FACT_HOURS, GOLD_HOURS, CENT = 24, 2, "0.01"


def suite() -> list[DqTest]:
    """The fifteen tests of the shop: what each one measures, and where."""
    c = F.col
    gap = F.abs(c("Quantity") * c("UnitPrice") - c("LineTotal"))
    frames = {
        "fact_no_duplicate_orderitemid": lambda t: _repeated(t["fact"], "OrderItemId"),
        "dim_customer_one_current_per_id": lambda t: _repeated(t["dim_customer"].where("IsCurrent"), "CustomerId"),
        "fact_customerkey_resolves": lambda t: _orphans(t["fact"], "CustomerKey", t["dim_customer"]),
        "fact_productkey_resolves": lambda t: _orphans(t["fact"], "ProductKey", t["dim_product"]),
        "fact_datekey_resolves": lambda t: _orphans(t["fact"], "DateKey", t["dim_date"]),
    }
    measures = {
        "fact_freshness_24h": ("fact", _any_since("EtlLoadedAt", FACT_HOURS)),
        "gold_freshness_2h": ("gold_daily", _any_since("RefreshedAt", GOLD_HOURS)),
        "fact_row_count_nonzero": ("fact", lambda as_of: F.count(F.lit(1))),
        "dim_customer_count_nonzero": ("dim_customer", _counts(c("IsCurrent"))),
        "fact_no_negative_revenue": ("fact", _counts(c("LineTotal") <= 0)),
        "fact_no_zero_quantity": ("fact", _counts(c("Quantity") <= 0)),
        "fact_unitprice_lineTotal_consistency": ("fact", _counts(gap > F.lit(CENT).cast("decimal(3,2)"))),
        "inventory_no_negative_stock": ("gold_inventory", _counts(c("CurrentStock") < 0)),
        "inventory_low_stock_watch": ("gold_inventory", _counts(c("LowStock"))),
        "payment_paid_not_exceed_total": ("gold_mix", _counts(c("PaidRevenue") > c("TotalRevenue"))),
    }
    wants_some = {"fact_freshness_24h", "gold_freshness_2h", "fact_row_count_nonzero", "dim_customer_count_nonzero"}
    tests = []
    for name, category, severity, expected in TESTS:
        table, measure = measures.get(name, (None, None))
        passes = _is_positive if name in wants_some else _is_zero
        tests.append(DqTest(name, category, severity, expected, passes, table, measure, frames.get(name)))
    return tests


def _told(test: DqTest, value: int | None, error: str | None, as_of: datetime) -> Column:
    number = F.lit(value).cast("long")
    status = F.lit("Fail") if error else F.when(test.passes(number), F.lit("Pass")).otherwise(F.lit("Fail"))
    return F.struct(
        F.lit(test.name).alias("TestName"), F.lit(test.category).alias("Category"),
        F.lit(test.severity).alias("Severity"), status.alias("Status"), number.cast("string").alias("ActualValue"),
        F.lit(test.expected).alias("ExpectedValue"), F.lit(error).cast("string").alias("Message"),
        ts(as_of).alias("RunAt"))


def _measured(tables: Tables, table: str, group: list[DqTest], as_of: datetime) -> dict[str, tuple[int | None, str | None]]:
    """The numbers of a table's tests from one scan; if one of them fails, each from a scan of its own."""
    try:
        row = tables[table].agg(*[t.measure(as_of).cast("long").alias(f"m{i}") for i, t in enumerate(group)]).first()
        return {t.name: (row[i], None) for i, t in enumerate(group)}
    except (KeyError, PySparkException) as error:
        if len(group) > 1:
            alone = [_measured(tables, table, [t], as_of) for t in group]
            return {name: found for part in alone for name, found in part.items()}
        return {group[0].name: (0, _message(error))}


def _framed(tables: Tables, test: DqTest) -> tuple[int | None, str | None]:
    try:
        numbers = test.frame(tables)
        return numbers.select(F.col(numbers.columns[0]).cast("long")).first()[0], None
    except (KeyError, PySparkException) as error:
        return 0, _message(error)


def _message(error: Exception) -> str:
    """The whole message of an error, without Spark's stack."""
    lines = str(error).strip().splitlines()
    return "\n".join(line for line in lines if not line.startswith(("\tat ", "JVM stacktrace"))).strip()


def run_suite(tables: Tables, tests: Sequence[DqTest], as_of: datetime) -> DataFrame:
    """One result row per test, each a single number that the run fetches.

    An error inside a test, in planning (a missing table or column) or at run time (a division by zero), is that test's
    failure with the error's message; the others go on.
    """
    spark = next(iter(tables.values())).sparkSession
    found: dict[str, tuple[int | None, str | None]] = {}
    with tidied(spark):
        for name in dict.fromkeys(t.table for t in tests if t.table):
            found |= _measured(tables, name, [t for t in tests if t.table == name], as_of)
        found |= {t.name: _framed(tables, t) for t in tests if t.frame}
    order = [t for t in tests if t.table] + [t for t in tests if t.frame]
    return spark.range(1).select(F.inline(F.array(*[_told(t, *found[t.name], as_of) for t in order])))


def summary(results: DataFrame) -> DataFrame:
    """Totals of a run; the alert is raised by one failed critical test."""
    failed = F.col("Status") == "Fail"
    return (results.agg(F.count(F.lit(1)).alias("Total"), F.count_if(failed).alias("Failed"),
                        F.count_if(failed & (F.col("Severity") == "Critical")).alias("Critical"))
            .withColumn("Alert", F.col("Critical") > 0))


def staleness(watermarks: DataFrame, as_of: datetime, max_minutes: int) -> DataFrame:
    """Health of the pipelines from the newest mark; no mark at all is healthy."""
    last = watermarks.agg(F.max("LastProcessedAt").alias("LastProcessedAt"))
    age = F.timestamp_diff("MINUTE", F.col("LastProcessedAt"), ts(as_of))
    stale = ts(as_of) > F.col("LastProcessedAt") + F.make_dt_interval(mins=F.lit(max_minutes))
    return last.select("LastProcessedAt", age.alias("AgeMinutes"),
                       F.when(stale, F.lit("Degraded")).otherwise(F.lit("Healthy")).alias("Status"))
