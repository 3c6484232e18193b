"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartwheel.functions.skew import first_claims, previous_value, running_total, time_chunk
from cartwheel.plans import etl_run, registry_jobs, reports
from cartwheel.plans.registry import END, FRAMES, START
from cartwheel.session import work_dir
from cartwheel.sources.warehouse import Warehouse


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(retail):
    return {name: plan(build(retail)) for name, build in FRAMES.items()}


def test_no_python_in_any_query(plans):
    assert not [n for n, p in plans.items() if re.search(r"Python|ArrowEval|MapInPandas", p)]


def test_no_cross_join(plans):
    assert not [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]


def test_reports_do_not_number_the_lines(plans):
    for name in ("gold_daily_sales_by_category", "report_sales_by_category", "gold_customer_lifetime_value",
                 "silver_sales_by_category", "oltp_sales_by_category_90d"):
        assert "Window" not in plans[name], name


def test_only_wanted_columns_are_read(plans):
    scans = re.findall(r"ReadSchema: struct<([^>]*l_orderkey[^>]*)>", plans["oltp_sales_by_category_90d"])
    for scan in scans:
        assert set(re.findall(r"l_\w+", scan)) <= {"l_orderkey", "l_partkey", "l_extendedprice"}


def test_top_lists_cut_groups_before_the_shuffle(plans):
    for name in ("gold_monthly_top_products", "related_products"):
        assert "WindowGroupLimit" in plans[name], name


def test_only_report_sized_windows_are_global(plans):
    loose = [n for n, p in plans.items() if "Window [" in p and "Exchange SinglePartition" in p
             and re.search(r"Window \[[^\]]*windowspecdefinition\((specifiedwindowframe|unspecifiedframe)", p)]
    assert set(loose) <= {"revenue_share"}


def test_fact_range_prunes_months(spark, retail):
    wh = Warehouse(spark, work_dir(spark, "test-plan"))
    source = registry_jobs._source(retail, 2, retail.order_items)
    etl_run.run_etl(wh, source, registry_jobs.S.AS_OF, with_quality=False)
    text = plan(reports.silver_sales_by_category(wh.read("fact"), wh.read("dim_product"), START, END))
    assert re.search(r"PartitionFilters: \[[^\]]*MonthKey", text) and "PushedFilters: [IsNotNull(DateKey)" in text
    assert "BroadcastHashJoin" in text
    assert re.search(r"ReadSchema: struct<DateKey:int,ProductKey:bigint,LineTotal:decimal\(18,2\)>", text)


# ---------------------------------------------------------------- skew helpers against a plain window
@pytest.fixture(scope="module")
def rows(spark):
    """Key 0 holds a third of the rows; the order has ties on the first column."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    return spark.range(3000).select("id", key.alias("k"), ((F.col("id") * 7919) % 400).alias("t"),
                                    F.when(F.col("id") % 11 != 0, F.col("id") % 13).alias("v"))


def test_running_total(rows):
    got = running_total(rows.fillna(0, ["v"]), ["k"], ["t", "id"], F.floor(F.col("t") / 10), "v", "total")
    want = rows.fillna(0, ["v"]).withColumn("total", F.expr(
        "sum(v) over (partition by k order by t, id rows unbounded preceding)"))
    assert got.exceptAll(want).isEmpty() and got.count() == 3000


def test_previous_value(rows):
    got = previous_value(rows, ["k"], ["t", "id"], F.floor(F.col("t") / 10), "v", "p")
    want = rows.withColumn("p", F.expr("lag(v) over (partition by k order by t, id)"))
    assert got.exceptAll(want).isEmpty() and got.count() == 3000


def test_time_chunks(rows):
    """Times on and off the minute; tiny id ranges."""
    timed = rows.fillna(0, ["v"]).withColumn("at", F.expr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, case when t % 3 = 0 then t div 30 * 60 else t end)"))
    chunk = time_chunk("at", "id", ids=100)
    got = running_total(timed, ["k"], ["at", "id"], chunk, "v", "x")
    assert got.exceptAll(timed.withColumn("x", F.expr(
        "sum(v) over (partition by k order by at, id rows unbounded preceding)"))).isEmpty()
    got = previous_value(timed, ["k"], ["at", "id"], chunk, "id", "x")
    assert got.exceptAll(timed.withColumn("x", F.expr("lag(id) over (partition by k order by at, id)"))).isEmpty()


def test_first_claims(rows):
    got = {r.k: r.Owner for r in first_claims(rows, "k", "id", rows.where("k = 7")).collect()}
    want = {r.k: (-1 if r.k == 7 else r.m) for r in rows.groupBy("k").agg(F.min("id").alias("m")).collect()}
    assert got == want


def test_entry_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_hot_product_is_split_when_the_products_cannot_be_broadcast(spark):
    """A third of the facts name one product; the join partition that gets them is read in pieces."""
    from cartwheel.operators import gold
    fact = spark.range(0, 600000, 1, 8).select(
        F.lit(20240101).alias("DateKey"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias(
            "ProductKey"), F.col("id").alias("OrderId"), (F.col("id") % 97).cast("decimal(18,2)").alias("LineTotal"))
    product = spark.range(5000).select(F.col("id").alias("ProductKey"), (F.col("id") % 7).cast("string")
                                       .alias("Category"))
    days = spark.sql("select 20240101 DateKey, date'2024-01-01' Date")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        daily = gold.daily_sales_by_category(fact, F.broadcast(days), product)
        rows = daily.collect()
        text = plan(daily)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sum(r.ItemCount for r in rows) == 600000 and sum(r.OrderCount for r in rows) == 600000
    assert "skew=true" in text
