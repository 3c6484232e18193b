"""Headline timings: the full load, then the category question asked of the source tables, silver and gold.

Prints one JSON line.  ``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import date, timedelta

from pyspark.sql import functions as F

from cartwheel import schemas as S
from cartwheel.operators import gold
from cartwheel.plans import etl_run, reports
from cartwheel.plans.registry import END, LAST_DAY, START
from cartwheel.session import build_session, work_dir
from cartwheel.sources.retail import Retail
from cartwheel.sources.warehouse import Warehouse
from cartwheel.streaming import jobs

RUNS = 5


def timed(build) -> float:
    """Median of a few runs after a warm-up; every run plans anew and fetches the whole result."""
    build().collect()
    taken = []
    for _ in range(RUNS):
        start = time.perf_counter()
        build().collect()
        taken.append(time.perf_counter() - start)
    return statistics.median(taken)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"), memory="12g")
    r = Retail(spark, folder)
    base = work_dir(spark, "bench")
    # the source system's tables as files, so that staging is not part of what is timed
    for name in ("customers", "products", "orders", "order_items"):
        getattr(r, name).write.parquet(f"{base}/source/{name}")
    read = {name: spark.read.parquet(f"{base}/source/{name}") for name in ("customers", "products", "orders",
                                                                          "order_items")}
    source = etl_run.Source(read["customers"], read["products"], read["orders"], read["order_items"])
    lines = read["order_items"].count()
    queries: dict[str, float] = {}

    wh = Warehouse(spark, f"{base}/batch")
    start = time.perf_counter()
    etl_run.run_etl(wh, source, S.AS_OF)
    queries["t1_full_load_batch"] = time.perf_counter() - start

    # the first load also starts the process; the second shows the load alone
    start = time.perf_counter()
    etl_run.run_etl(Warehouse(spark, f"{base}/batch-again"), source, S.AS_OF)
    queries["t1_full_load_batch_again"] = time.perf_counter() - start

    streamed = Warehouse(spark, f"{base}/stream")
    start = time.perf_counter()
    jobs.run_etl_stream(streamed, f"{base}/source/order_items", source, S.AS_OF, f"{base}/checkpoint",
                        with_quality=True)
    queries["t1_full_load_stream"] = time.perf_counter() - start

    fact, product, days = wh.read("fact"), wh.read("dim_product"), wh.read("dim_date")
    daily, monthly, inventory = wh.read("gold_daily"), wh.read("gold_monthly"), wh.read("gold_inventory")
    mix, months = wh.read("gold_orders"), wh.read("gold_product_months")
    whole = (date(1990, 1, 1), date(2010, 1, 1))
    queries["g1_daily_sales_by_category"] = timed(lambda: gold.daily_sales_by_category(fact, days, product))
    queries["g2_monthly_top_products"] = timed(lambda: gold.monthly_top_products(fact, days, product))
    queries["r1_gold_sales_by_category"] = timed(lambda: reports.sales_by_category(daily, START, END))
    queries["r2_gold_sales_by_day"] = timed(lambda: reports.sales_by_day(daily, START, END))
    queries["r3_gold_top_products"] = timed(lambda: reports.top_products(monthly, START, END))
    queries["r6_gold_low_stock"] = timed(lambda: reports.low_stock(inventory))
    queries["r10_silver_sales_by_category"] = timed(
        lambda: reports.silver_sales_by_category(fact, product, START, END))
    queries["r10_silver_sales_by_category_all"] = timed(
        lambda: reports.silver_sales_by_category(fact, product, *whole))
    queries["r10_silver_sales_by_category_90d"] = timed(
        lambda: reports.silver_sales_by_category(fact, product, LAST_DAY - timedelta(days=90), LAST_DAY))
    queries["r11_source_sales_by_category_90d"] = timed(
        lambda: reports.oltp_sales_by_category(read["order_items"], read["orders"], read["products"], LAST_DAY))
    queries["r8_exact_orders"] = timed(lambda: reports.exact_orders(fact, START, END))
    queries["r8_exact_orders_from_mix"] = timed(lambda: reports.exact_orders_of(mix, START, END))
    queries["r3_top_products_exact"] = timed(lambda: reports.top_products_exact(months, product, START, END))
    facts = fact.agg(F.count(F.lit(1))).first()[0]
    print(json.dumps({"metric": "total of headline queries", "value": round(sum(queries.values()), 3), "unit": "sec",
                      "queries": {k: round(v, 4) for k, v in queries.items()}, "sf": os.path.basename(folder),
                      "lines": lines, "facts": facts,
                      "load_rows_per_sec": round(lines / queries["t1_full_load_batch"])}))
    spark.stop()


if __name__ == "__main__":
    main()
