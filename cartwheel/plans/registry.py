"""The registered queries: name -> frame over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel import schemas as S
from cartwheel.functions.scalars import compact_label, row_hash, ts, vnd_label
from cartwheel.operators import acceptance, adhoc, answer_cache, dims, etl, feeds, gold, gold_state, guard, lookups
from cartwheel.operators import orders, outbox, payments, quality, validation
from cartwheel.plans import evaluation, registry_jobs, reports
from cartwheel.session import dropped, released, tune, written
from cartwheel.sources import readers
from cartwheel.sources.retail import STATEMENTS, Retail

START, END = date(1997, 1, 15), date(1999, 3, 20)
LAST_DAY = date(2001, 8, 1)
MONTH = (1998, 5)
YEAR, CATEGORY = 1998, "ECONOMY"
VNPAY_SECRET, MOMO_SECRET, MOMO_ACCESS = "vnpay-test-secret", "momo-test-secret", "ACCESS"
#: the question passed to the guard as text, over the whitelisted daily table
GUARDED = """
WITH yearly AS (SELECT Category, year(Date) AS Yr, sum(TotalRevenue) AS Revenue, sum(OrderCount) AS Orders
                FROM DailySalesByCategory GROUP BY Category, year(Date))
SELECT Category, Yr, Revenue, Orders FROM yearly WHERE Orders > 10 ORDER BY Revenue DESC;
"""


# ---- frames shared by several queries --------------------------------------------------------------------------------
def _daily(r: Retail) -> DataFrame:
    return gold.daily_sales_by_category(r.fact, r.dim_date, r.dim_product)


def _monthly(r: Retail) -> DataFrame:
    return gold.monthly_top_products(r.fact, r.dim_date, r.dim_product)


def _clv(r: Retail) -> DataFrame:
    return gold.customer_lifetime_value(r.fact, r.dim_date, r.dim_customer, S.AS_OF)


def _mix(r: Retail) -> DataFrame:
    return gold.sales_by_payment_method(r.orders)


def _inventory(r: Retail, all_versions: bool = False) -> DataFrame:
    return gold.product_inventory(r.fact, r.dim_product, r.products, all_versions)


def _by_category(r: Retail) -> DataFrame:
    return reports.sales_by_category(_daily(r), START, END)


def _by_day(r: Retail) -> DataFrame:
    return reports.sales_by_day(_daily(r), START, END)


def _first_load(r: Retail) -> DataFrame:
    """Lines of the first load."""
    first = r.orders_in_loads.where("Load = 1").select("OrderId")
    return r.order_items.join(first, "OrderId", "left_semi")


def _state(r: Retail) -> DataFrame:
    """Watermarks before the second load: the sales pipeline and one other."""
    empty = _first_load(r).select(F.lit("").alias("PipelineName"), F.col("OrderItemId").alias("LastProcessedRowId"),
                                  ts(S.FIRST_LOAD).alias("LastProcessedAt")).where(F.lit(False))
    sales = etl.advance_watermark(empty, _first_load(r), S.PIPELINE, S.FIRST_LOAD)
    other = r.orders.agg(F.max("OrderId").alias("LastProcessedRowId")).select(
        F.lit("Orders").alias("PipelineName"), "LastProcessedRowId", ts(S.FIRST_LOAD).alias("LastProcessedAt"))
    return sales.unionByName(other)


def _extract(r: Retail) -> DataFrame:
    mark = _state(r).where(F.col("PipelineName") == S.PIPELINE).agg(F.max("LastProcessedRowId")).scalar()
    return etl.incremental_extract(r.order_items, r.orders, mark)


def _watermark(r: Retail) -> DataFrame:
    return etl.advance_watermark(_state(r), _extract(r), S.PIPELINE, S.SECOND_LOAD)


def _bronze(r: Retail) -> DataFrame:
    """Raw lines by (order, line number), which the test data repeats; even orders are landed already."""
    key = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("LineKey")
    raw = r.table("lineitem").select(key, F.col("l_orderkey").alias("OrderId"), F.col("l_partkey").alias("ProductId"),
                                     F.col("l_suppkey").alias("SupplierId"), F.col("l_quantity").cast("int")
                                     .alias("Quantity"), F.col("l_extendedprice").cast(S.MONEY).alias("LineTotal"))
    landed = r.table("orders").select(F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(7)), lambda n: F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") * 8 + n)
        .otherwise(-1 - n))).alias("LineKey"))
    return etl.bronze_new_rows(raw, landed, "LineKey")


def _dq(name: str) -> Callable[[Retail], DataFrame]:
    def run(r: Retail) -> DataFrame:
        test = [t for t in quality.suite() if t.name == name]
        return quality.run_suite(r.faulty_star, test, S.AS_OF)
    return run


def _suite(r: Retail) -> DataFrame:
    """All tests over the broken star; the tables that several of them read are computed once, and dropped at the end.

    A table that cannot be computed as a whole stays lazy, so that only the tests which meet the error fail.
    """
    star, kept = r.faulty_star, {}
    for name in ("fact", "dim_customer"):
        try:
            kept[name] = written(r.spark, star[name], f"faulty-{name}")
        except (PySparkException, Py4JJavaError):
            pass
        released(r.spark)
    results = quality.run_suite(star | kept, quality.suite(), S.AS_OF)
    dropped(r.spark, *kept.values())
    return results


def _matching_orders(r: Retail) -> DataFrame:
    return lookups.matching_orders(r.orders, r.customers, status=S.DELIVERED, date_from="1996-01-01",
                                   date_to="2000-12-31", search="customer#0000000")


def _settled(r: Retail) -> DataFrame:
    return payments.settle(r.callbacks, r.payments)


def _signed(r: Retail) -> DataFrame:
    """Signed callbacks; every seventh is changed after signing."""
    signed = payments.sign(r.raw_callbacks, VNPAY_SECRET, MOMO_SECRET, MOMO_ACCESS)
    forged = F.map_zip_with("Params", F.create_map(F.lit("vnp_Amount"), F.lit("1"), F.lit("amount"), F.lit("1")),
                            lambda k, old, new: F.when(old.isNotNull(), F.coalesce(new, old)))
    return signed.withColumn("Params", F.when(F.col("Seq") % 7 == 0, forged).otherwise(F.col("Params")))


def _feed_summary(r: Retail) -> DataFrame:
    loads = [("customers", r.customer_feed, _customers_feed(r)), ("products", r.product_feed, _products_feed(r)),
             ("orders", r.order_feed, _orders_feed(r))]
    frames = [feeds.feed_summary(kind, feed, loaded) for kind, feed, loaded in loads]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _customers_feed(r: Retail) -> feeds.Loaded:
    return feeds.load_customers(r.customer_feed, r.known_emails)


def _products_feed(r: Retail) -> feeds.Loaded:
    return feeds.load_products(r.product_feed, r.known_skus)


def _orders_feed(r: Retail) -> feeds.Loaded:
    return feeds.load_orders(r.order_feed, r.customers, r.products, S.AS_OF)


def _incremental_gold(r: Retail) -> DataFrame:
    """Gold of the first load brought up to date with the rows of the second."""
    first = r.resolved_lines.where("Load = 1")
    old = gold.daily_sales_by_category(etl.silver_fact(first, S.AS_OF), r.dim_date, r.dim_product)
    new = etl.silver_fact(r.resolved_lines.where("Load = 2"), S.AS_OF)
    return gold.daily_sales_incremental(old, new, r.fact, r.dim_date, r.dim_product)


def _of_load(r: Retail, load: int) -> DataFrame:
    return etl.silver_fact(r.resolved_lines.where(F.col("Load") == load), S.AS_OF)


def _product_months(r: Retail) -> DataFrame:
    """The parts that two loads leave behind."""
    parts = [gold_state.product_months(_of_load(r, load), r.dim_date) for load in (1, 2)]
    return parts[0].unionByName(parts[1])


def _incremental_monthly(r: Retail) -> DataFrame:
    old = gold.monthly_top_products(_of_load(r, 1), r.dim_date, r.dim_product)
    added = gold_state.product_months(_of_load(r, 2), r.dim_date)
    return gold_state.monthly_incremental(old, _product_months(r), added, r.dim_product)


def _incremental_clv(r: Retail) -> DataFrame:
    old = gold.customer_lifetime_value(_of_load(r, 1), r.dim_date, r.dim_customer, S.FIRST_LOAD)
    return gold_state.lifetime_value_incremental(old, _of_load(r, 2), _of_load(r, 1), r.dim_date, r.dim_customer, S.AS_OF)


def _order_mix(r: Retail) -> DataFrame:
    """The mix of the first load brought up to date with the rows of the second."""
    old = gold_state.order_mix(_of_load(r, 1), r.dim_date, r.dim_product)
    return gold_state.order_mix_incremental(old, _of_load(r, 2), r.fact, r.dim_date, r.dim_product)


#: category sets whose distinct orders are asked for; the empty one asks for all
CATEGORY_SETS = ((), (CATEGORY,), (CATEGORY, "PROMO"))


def _orders_by_set(r: Retail) -> DataFrame:
    mix = gold_state.order_mix(r.fact, r.dim_date, r.dim_product)
    rows = [reports.exact_orders_of(mix, START, END, names).withColumn("Categories", F.lit("|".join(names)))
            for names in CATEGORY_SETS]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _asof(r: Retail, find=dims.as_of_join) -> DataFrame:
    """Each line with the versions valid at the order's time."""
    orders_ = find(r.orders.select("OrderId", "CustomerId", "OrderDate"), "OrderDate",
                              r.dim_customer.withColumnRenamed("CustomerKey", "CustomerKeyAsOf"),
                              dims.Scd2("CustomerId", "CustomerKeyAsOf", ()))
    lines = r.order_items.select("OrderItemId", "OrderId", "ProductId").join(orders_, "OrderId")
    return find(lines, "OrderDate", r.dim_product.withColumnRenamed("ProductKey", "ProductKeyAsOf"),
                           dims.Scd2("ProductId", "ProductKeyAsOf", ())).select(
        "OrderItemId", "OrderId", "CustomerKeyAsOf", "ProductKeyAsOf")


def _history(r: Retail) -> DataFrame:
    frames = [dims.version_history(frame, dim).withColumnRenamed(dim.key, "NaturalId").withColumn("Dimension", F.lit(n))
              for n, frame, dim in (("customer", r.dim_customer, dims.CUSTOMER),
                                    ("product", r.dim_product, dims.PRODUCT))]
    return frames[0].unionByName(frames[1])


def _equivalence(r: Retail) -> DataFrame:
    """Units sold counted over current product versions against all versions."""
    cut = [_inventory(r, flag).select("ProductId", "UnitsSold", "LowStock") for flag in (False, True)]
    return adhoc.result_difference(*cut)


def _guarded(r: Retail) -> DataFrame:
    return guard.guarded_sql({"DailySalesByCategory": _daily(r)}, GUARDED).rows


#: the question set of the scoreboard: question, difficulty and a statement that tells the right answer
QUESTION_SET = [
    ("What was total revenue in 2024?", "easy",
     "SELECT SUM(GrossAmount - DiscountAmount) FROM FactOrderItem WHERE DateKey DIV 10000 = 2024"),
    ("Revenue by payment method", "easy",
     "SELECT PaymentMethod AS m, SUM(GrossAmount) - SUM(DiscountAmount) AS r FROM FactOrderItem GROUP BY PaymentMethod"),
    ("Top 3 stores by revenue", "medium",
     "SELECT s.StoreName, t.r FROM (SELECT StoreKey, SUM(LineTotal) AS r FROM FactOrderItem GROUP BY StoreKey) t "
     "JOIN DimStore s ON s.StoreKey = t.StoreKey ORDER BY t.r DESC, s.StoreName LIMIT 3"),
    # nobody prepared an answer to this one
    ("Which shelf is empty?", "hard", "SELECT ProductName FROM DimProduct WHERE BasePrice < 0"),
]


def _asked(r: Retail) -> DataFrame:
    questions = r.spark.createDataFrame([("", "", level, question, sql) for question, level, sql in QUESTION_SET],
                                        readers.QUESTIONS)
    return adhoc.eval_scoreboard(evaluation.score_asked(r.questions, questions, r.star))


def _guarded_statements(r: Retail) -> DataFrame:
    cases = r.spark.createDataFrame([("", "reject" if kind in ("click", "error") else "allow", sql)
                                     for kind, sql in STATEMENTS.items()], readers.SAFETY)
    return adhoc.safety_scoreboard(evaluation.score_statements(r.statements, cases, {"DailySalesByCategory": _daily(r)}))


def _rendered(r: Retail) -> DataFrame:
    return outbox.render(outbox.pending(r.outbox), r.orders, _with_gaps(r.customers))


def _with_gaps(customers: DataFrame) -> DataFrame:
    """Some customers have no address."""
    return customers.withColumn("Email", F.when(F.col("CustomerId") % 14 == 0, F.lit("")).otherwise(F.col("Email")))


def _category_days(r: Retail) -> DataFrame:
    return (_daily(r).where(F.col("Category") == CATEGORY).groupBy("Date")
            .agg(F.sum("TotalRevenue").alias("Revenue")))


def _before_refund(r: Retail) -> DataFrame:
    return r.orders.withColumn("PaymentStatus", F.when(F.col("PaymentStatus") == 5, 3)
                               .otherwise(F.col("PaymentStatus")))


FRAMES: dict[str, Callable[[Retail], DataFrame]] = {
    # ingest
    "incremental_extract": _extract,
    "watermark_advance": _watermark,
    "bronze_dedup": _bronze,
    "silver_fact": lambda r: r.fact.drop("EtlLoadedAt"),
    "fact_quarantine": lambda r: etl.fact_quarantine(r.resolved_lines),
    "stg_orders_payment": lambda r: r.orders.select("OrderId", "Status", "PaymentMethod", "PaymentStatus"),
    "fnb_dim_customer": lambda r: r.star["DimCustomer"],
    "fnb_dim_date": lambda r: dims.date_dim_between(r.orders, "OrderDate", first_day="monday"),
    "fnb_fact": lambda r: r.star["FactOrderItem"],
    # dimensions
    "scd2_customer": lambda r: r.dim_customer,
    "scd2_product": lambda r: r.dim_product,
    "dim_date": lambda r: r.dim_date,
    "row_hash": lambda r: r.customers.select("CustomerId", row_hash(dims.CUSTOMER.tracked).alias("RowHash")),
    "fact_asof_dims": _asof,
    "fact_asof_carried": lambda r: _asof(r, dims.as_of_carried),
    "scd2_history": _history,
    # gold
    "gold_daily_sales_by_category": _daily,
    "gold_monthly_top_products": _monthly,
    "gold_customer_lifetime_value": _clv,
    "gold_sales_by_payment_method": _mix,
    "gold_order_funnel": lambda r: gold.order_funnel(r.orders),
    "gold_product_inventory": _inventory,
    "gold_product_inventory_all_versions": lambda r: _inventory(r, True),
    "gold_daily_incremental": _incremental_gold,
    "gold_monthly_incremental": _incremental_monthly,
    "gold_clv_incremental": _incremental_clv,
    "gold_inventory_from_parts": lambda r: gold.product_inventory(_product_months(r), r.dim_product, r.products),
    "gold_order_mix": lambda r: _order_mix(r).withColumn("Categories", F.array_join("Categories", "|")),
    # reports
    "report_sales_by_category": _by_category,
    "report_sales_by_day": _by_day,
    "report_top_products": lambda r: reports.top_products(_monthly(r), START, END),
    "report_top_products_exact": lambda r: reports.top_products_exact(_product_months(r), r.dim_product, START, END),
    "report_payment_mix": lambda r: reports.payment_mix(_mix(r)),
    "report_order_funnel": lambda r: reports.funnel(gold.order_funnel(r.orders)),
    "report_low_stock": lambda r: reports.low_stock(_inventory(r)),
    "kpi_tiles": lambda r: reports.kpi_tiles(_by_category(r)),
    "kpi_exact_orders": lambda r: reports.exact_orders(r.fact, START, END),
    "kpi_orders_by_set": _orders_by_set,
    "chart_sales_by_day": lambda r: reports.chart_by_day(_by_day(r)),
    "silver_sales_by_category": lambda r: reports.silver_sales_by_category(r.fact, r.dim_product, START, END),
    "oltp_sales_by_category_90d": lambda r: reports.oltp_sales_by_category(r.order_items, r.orders, r.products,
                                                                           LAST_DAY),
    "revenue_share": lambda r: reports.revenue_share(_by_category(r), "Category"),
    "payment_paid_ratio": lambda r: reports.paid_ratio(_mix(r)),
    # data quality
    "dq_fact_duplicates": _dq("fact_no_duplicate_orderitemid"),
    "dq_one_current_customer": _dq("dim_customer_one_current_per_id"),
    "dq_orphan_customer": _dq("fact_customerkey_resolves"),
    "dq_orphan_product": _dq("fact_productkey_resolves"),
    "dq_orphan_date": _dq("fact_datekey_resolves"),
    "dq_fact_freshness": _dq("fact_freshness_24h"),
    "dq_gold_freshness": _dq("gold_freshness_2h"),
    "dq_fact_nonempty": _dq("fact_row_count_nonzero"),
    "dq_customer_nonempty": _dq("dim_customer_count_nonzero"),
    "dq_negative_revenue": _dq("fact_no_negative_revenue"),
    "dq_zero_quantity": _dq("fact_no_zero_quantity"),
    "dq_line_consistency": _dq("fact_unitprice_lineTotal_consistency"),
    "dq_negative_stock": _dq("inventory_no_negative_stock"),
    "dq_low_stock": _dq("inventory_low_stock_watch"),
    "dq_paid_le_total": _dq("payment_paid_not_exceed_total"),
    "dq_suite": _suite,
    "dq_summary": lambda r: quality.summary(_suite(r)),
    "etl_freshness": lambda r: quality.staleness(_watermark(r), S.AS_OF, S.STALE_MINUTES),
    # read models
    "order_list_page": lambda r: lookups.order_page(_matching_orders(r), r.order_items, page=2, size=20),
    "order_list_deep": lambda r: lookups.order_page_deep(lookups.matching_orders(
        r.orders, r.customers, status=S.DELIVERED, date_from="1996-01-01", date_to="2000-12-31"), r.order_items, 9, 20),
    "product_search": lambda r: lookups.product_page(lookups.matching_products(r.products, "RING", CATEGORY), 1, 50),
    "customer_search": lambda r: lookups.customer_page(lookups.matching_customers(r.customers, "nation_1"), 2, 50),
    "page_counts": lambda r: lookups.page_counts(_matching_orders(r), 20),
    "categories": lambda r: lookups.categories(r.products),
    "order_documents": lambda r: lookups.order_documents(r.orders, r.customers, r.order_items, r.products,
                                                         r.order_events),
    "related_products": lambda r: lookups.related_products(r.products),
    "address_default": lambda r: lookups.address_book(r.addresses),
    "products_unreferenced": lambda r: lookups.products_unreferenced(r.products_with_new, r.order_items),
    # feeds and rules
    "feed_customers_ok": lambda r: _customers_feed(r).accepted,
    "feed_customers_err": lambda r: _customers_feed(r).errors,
    "feed_products_ok": lambda r: _products_feed(r).accepted,
    "feed_products_err": lambda r: _products_feed(r).errors,
    "feed_orders_ok": lambda r: _orders_feed(r).accepted,
    "feed_orders_err": lambda r: _orders_feed(r).errors,
    "feed_summary": _feed_summary,
    "validate_orders": lambda r: validation.validate_orders(r.checkout_headers, r.checkout_lines),
    "validate_products": lambda r: validation.validate_products(r.product_drafts),
    "validate_customers": lambda r: validation.validate_customers(r.registrations),
    # orders, payments, notifications
    "order_pricing": lambda r: orders.price_orders(r.order_requests, r.products),
    "order_demand": lambda r: orders.order_demand(r.order_requests, r.products),
    "oversell_flags": lambda r: orders.oversell_flags(r.order_requests, r.orders, r.products),
    "order_acceptance": lambda r: acceptance.accept_orders(r.order_requests, r.orders, r.products),
    "stock_position": lambda r: orders.stock_position(r.order_items, r.orders, r.products),
    "transition_audit": lambda r: orders.audit_transitions(r.order_events),
    "order_next_states": lambda r: orders.order_next_states(r.orders),
    "refund_marking": lambda r: orders.mark_refunds(_before_refund(r)).select("OrderId", "Status", "PaymentStatus"),
    "cancel_eligibility": lambda r: orders.cancel_eligibility(r.owner_requests, r.orders),
    "payment_eligibility": lambda r: orders.payment_eligibility(r.owner_requests, r.orders),
    "callback_canonical_vnpay": lambda r: r.raw_callbacks.where(F.col("Provider") == S.VNPAY).select(
        "Seq", payments.canonical_vnpay(F.col("Params")).alias("Canonical")),
    "callback_canonical_momo": lambda r: r.raw_callbacks.where(F.col("Provider") == S.MOMO).select(
        "Seq", payments.canonical_momo(F.col("Params"), MOMO_ACCESS).alias("Canonical")),
    "callback_signature": lambda r: payments.verify(_signed(r), VNPAY_SECRET, MOMO_SECRET, MOMO_ACCESS),
    "payment_settlement": _settled,
    "payment_outcomes": lambda r: payments.payment_outcomes(_settled(r), r.orders),
    "outbox_pending": lambda r: outbox.next_batch(r.outbox),
    "outbox_rendered": _rendered,
    "outbox_result": lambda r: outbox.mark(outbox.pending(r.outbox), r.orders, r.delivery_log, S.AS_OF),
    "compact_labels": lambda r: r.orders.select("OrderId", compact_label(F.col("TotalAmount")).alias("Compact"),
                                                compact_label(F.col("TotalAmount") * F.col("OrderId"), True)
                                                .alias("CompactVnd"), vnd_label(F.col("TotalAmount")).alias("Vnd")),
    # ad-hoc
    "fnb_revenue_2024": lambda r: adhoc.star_revenue(r.star, 2024),
    "fnb_top5_products": lambda r: adhoc.star_top_products(r.star),
    "fnb_city_2025": lambda r: adhoc.star_revenue_by_city(r.star, 2025),
    "fnb_orders_2025": lambda r: adhoc.star_orders(r.star, 2025),
    "fnb_by_method": lambda r: adhoc.star_by_method(r.star),
    "fnb_by_tier_2024": lambda r: adhoc.star_by_tier(r.star, 2024),
    "fnb_monthly_2025": lambda r: adhoc.star_monthly(r.star, 2025),
    "fnb_top3_stores": lambda r: adhoc.star_top_stores(r.star),
    "fnb_top_price": lambda r: adhoc.top_price(r.products.select("ProductId", "Name", "Category", "Price"), "Price",
                                               "ProductId"),
    "adhoc_total_revenue": lambda r: _daily(r).agg(F.sum("TotalRevenue").alias("TotalRevenue")),
    "adhoc_by_category": lambda r: _daily(r).groupBy("Category").agg(F.sum("TotalRevenue").alias("Revenue"))
    .orderBy(F.desc("Revenue"), "Category"),
    "adhoc_month_top": lambda r: _monthly(r).where((F.col("Year") == MONTH[0]) & (F.col("Month") == MONTH[1])
                                                   & (F.col("RankInMonth") <= 10))
    .select("RankInMonth", "ProductName", "TotalQuantity", "TotalRevenue").orderBy("RankInMonth"),
    "adhoc_top_customers": lambda r: _clv(r).select("CustomerId", "TotalOrders", "TotalRevenue", "AvgOrderValue")
    .orderBy(F.desc("TotalRevenue"), "CustomerId").limit(10),
    "adhoc_churned": lambda r: _clv(r).where("DaysSinceLastOrder > 60").agg(F.count(F.lit(1))
                                                                            .alias("ChurnedCustomers")),
    "adhoc_category_trend": lambda r: _category_days(r).orderBy("Date"),
    "adhoc_max_aov": lambda r: _clv(r).agg(F.max("AvgOrderValue").alias("MaxAvgOrderValue")),
    "adhoc_best_category": lambda r: _daily(r).where(F.year("Date") == YEAR).groupBy("Category")
    .agg(F.sum("TotalRevenue").alias("Revenue")).orderBy(F.desc("Revenue"), "Category").limit(1),
    "adhoc_year_revenue": lambda r: _daily(r).where(F.year("Date") == YEAR).agg(F.sum("TotalRevenue")
                                                                                .alias("TotalRevenue")),
    "guarded_sql": _guarded,
    "canned_match": lambda r: adhoc.canned_match(r.questions, adhoc.CANNED, adhoc.FALLBACK),
    "result_equivalence": _equivalence,
    "eval_scoreboard": _asked,
    "safety_scoreboard": _guarded_statements,
    "ask_metrics": lambda r: adhoc.ask_metrics(r.ask_log),
    "ask_repeats": lambda r: adhoc.repeat_questions(r.ask_log),
    "ask_cache_hits": lambda r: answer_cache.cache_hits(r.ask_log),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Retail], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Retail(tune(spark), folder))

    return {name: bind(build) for name, build in (FRAMES | registry_jobs.FRAMES).items()}
