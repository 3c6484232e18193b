"""Warehouse, load runs, streams and readers."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel import schemas as S
from cartwheel.operators import quality
from cartwheel.plans import etl_run, maintenance
from cartwheel.session import work_dir
from cartwheel.sources import readers
from cartwheel.sources.warehouse import Warehouse
from cartwheel.streaming import jobs

T1, T2 = datetime(2024, 1, 2), datetime(2024, 1, 3)


def _source(spark, lines, customers=(1, 2), moved=None):
    people = spark.createDataFrame([(i, f"C{i}", f"c{i}@x", moved if i == 1 else None) for i in customers],
                                   "CustomerId long, FullName string, Email string, City string")
    goods = spark.createDataFrame([(1, "S1", "Pen", "Office", None, Decimal(2), 10),
                                   (2, "S2", "Cup", "Home", "B", Decimal(3), 30)],
                                  "ProductId long, Sku string, Name string, Category string, Brand string, "
                                  "Price decimal(18,2), StockQuantity int")
    heads = spark.createDataFrame([(1, 1, T1, 2, 2, 3, Decimal(10)), (2, 2, T1, 1, 1, 1, Decimal(5)),
                                   (3, 1, T2, 4, 1, 3, Decimal(7))],
                                  "OrderId long, CustomerId long, OrderDate timestamp_ntz, Status int, "
                                  "PaymentMethod int, PaymentStatus int, TotalAmount decimal(18,2)")
    items = spark.createDataFrame([(i, o, p, 1, Decimal(v), Decimal(v)) for i, o, p, v in lines], S.ORDER_ITEMS)
    return etl_run.Source(people, goods, heads, items)


LINES = [(10, 1, 1, 2), (11, 1, 2, 3), (20, 2, 1, 2), (30, 3, 9, 4)]


def test_batch_runs(spark):
    wh = Warehouse(spark, work_dir(spark, "test-batch"))
    first = etl_run.run_etl(wh, _source(spark, LINES[:2]), T1)
    assert (first.rows, first.watermark) == (2, 11)
    second = etl_run.run_etl(wh, _source(spark, LINES, moved="HN"), T2)
    assert (second.rows, second.watermark) == (1, 30)  # line 30 names an unknown product
    fact = {r.OrderItemId: r for r in wh.read("fact").collect()}
    assert fact[10].CustomerKey == 1001 and fact[20].CustomerKey == 2001 and fact[10].MonthKey == 202401
    lost = wh.read("quarantine").collect()
    assert [(r.OrderItemId, r.Reason) for r in lost] == [(30, "unknown product")]
    assert wh.read("bronze").count() == 4 and wh.read("dim_customer").count() == 3
    third = etl_run.run_etl(wh, _source(spark, LINES, moved="HN"), T2)
    assert third.rows == 0 and wh.read("bronze").count() == 4 and wh.read("dim_customer").count() == 3
    assert [r.RowsProcessed for r in wh.read("run_log").orderBy("RowsProcessed").collect()] == [0, 1, 2]
    assert wh.read("dq_results").count() == 45
    assert wh.read("gold_daily").agg(F.sum("TotalRevenue")).first()[0] == 7
    state = quality.staleness(wh.watermarks(), T2, 90).first()
    assert state.Status == "Healthy"
    # another process sees the same tables
    assert Warehouse(spark, wh.root).watermark(S.PIPELINE) == 30


def test_incremental_gold_equals_full_gold(spark, retail):
    from cartwheel.plans import registry_jobs
    wh = Warehouse(spark, work_dir(spark, "test-gold"))
    for load, as_of in registry_jobs.LOADS:
        source = registry_jobs._source(retail, load, registry_jobs._items_of(retail, 1) if load == 1
                                       else retail.order_items)
        etl_run.run_etl(wh, source, as_of, with_quality=False, incremental_gold=True)
    _gold_is_full(wh, source, as_of)


def _gold_is_full(wh, source, as_of):
    """Every gold table over the fact equals its full rebuild."""
    from cartwheel.operators import gold, gold_state
    fact, days, product = wh.read("fact"), wh.read("dim_date"), wh.read("dim_product")
    for table, full in (("gold_daily", gold.daily_sales_by_category(fact, days, product)),
                        ("gold_orders", gold_state.order_mix(fact, days, product)),
                        ("gold_monthly", gold.monthly_top_products(fact, days, product)),
                        ("gold_clv", gold.customer_lifetime_value(fact, days, wh.read("dim_customer"), as_of)),
                        ("gold_inventory", gold.product_inventory(fact, product, source.products))):
        have = wh.read(table).select(full.columns)
        assert have.schema.simpleString() == full.schema.simpleString(), table
        assert have.exceptAll(full).isEmpty() and have.count() == full.count(), table


def test_gold_follows_loads_that_add_to_known_orders(spark, retail):
    """Lines arrive one by one: late lines of loaded orders, a compaction and a reload in between."""
    wh = Warehouse(spark, work_dir(spark, "test-gold-steps"))
    for number in range(1, len(LINES) + 1):
        source = _source(spark, LINES[:number])
        etl_run.run_etl(wh, source, T1, with_quality=False, incremental_gold=True)
        _gold_is_full(wh, source, T1)
    maintenance.compact_fact(wh, T2)
    etl_run.run_etl(wh, source, T2, with_quality=False, incremental_gold=True)
    _gold_is_full(wh, source, T2)


def test_a_failed_run_is_in_the_log(spark, monkeypatch):
    wh = Warehouse(spark, work_dir(spark, "test-failed"))
    monkeypatch.setattr(etl_run, "refresh_gold", lambda *a, **k: (_ for _ in ()).throw(OSError("disk gone")))
    with pytest.raises(OSError):
        etl_run.run_etl(wh, _source(spark, LINES[:2]), T1, with_quality=False)
    [row] = wh.read("run_log").collect()
    assert (row.Status, row.RowsProcessed, row.ErrorMessage) == ("Failed", 2, "OSError: disk gone")
    monkeypatch.undo()
    etl_run.run_etl(wh, _source(spark, LINES[:2]), T2, with_quality=False)
    assert sorted(r.Status for r in wh.read("run_log").collect()) == ["Failed", "Succeeded"]


def test_nothing_shows_before_the_commit_and_a_retry_loads_once(spark):
    wh = Warehouse(spark, work_dir(spark, "test-retry"))
    source = _source(spark, LINES[:3])
    etl_run.refresh_dimensions(wh, source, T1)
    lines = etl_run.etl.incremental_extract(source.items, source.orders, 0)
    real, calls = wh.commit, []

    def broken(*args, **kw):
        calls.append(args)
        raise OSError("lost the driver")

    wh.commit = broken
    with pytest.raises(OSError):
        etl_run.load_batch(wh, lines, source, T1, "t", 1, 20)
    assert calls and wh.read("fact") is None and wh.read("bronze") is None and wh.watermark(S.PIPELINE) == 0
    wh.commit = real
    assert etl_run.load_batch(wh, lines, source, T1, "t", 1, 20).rows == 3
    assert etl_run.load_batch(wh, lines, source, T1, "t", 1, 20).rows == 0  # same token
    assert wh.read("fact").count() == 3 and wh.watermark(S.PIPELINE) == 20


def test_stream_keeps_late_lines_and_drops_copies(spark):
    base = work_dir(spark, "test-stream")
    wh, items, check = Warehouse(spark, f"{base}/w"), f"{base}/items", f"{base}/check"
    _source(spark, LINES[1:3]).items.coalesce(1).write.mode("append").parquet(items)
    assert jobs.run_etl_stream(wh, items, _source(spark, LINES), T1, check) == 2
    # a late line with a low id, and a line that was delivered before
    _source(spark, [LINES[0], LINES[2]]).items.coalesce(1).write.mode("append").parquet(items)
    assert jobs.run_etl_stream(wh, items, _source(spark, LINES), T2, check) == 1
    assert sorted(r.OrderItemId for r in wh.read("fact").collect()) == [10, 11, 20]
    assert wh.watermark(S.PIPELINE) == 20
    assert jobs.run_etl_stream(wh, items, _source(spark, LINES), T2, check) == 0


def test_compaction_and_reset(spark):
    wh = Warehouse(spark, work_dir(spark, "test-upkeep"))
    for n in (2, 3, 3):
        etl_run.run_etl(wh, _source(spark, LINES[:n]), T1, with_quality=False)
    before = sorted(map(str, wh.read("fact").collect()))
    stats = {r.Stage: r for r in maintenance.compact_fact(wh, T1).collect()}
    assert stats["before"].Files == 2 and stats["after"].Files == 1 and stats["after"].TotalRows == 3
    assert sorted(map(str, wh.read("fact").collect())) == before
    assert len(maintenance.compact_fact(wh, T1, small=1).collect()) == 1  # nothing small: skipped
    maintenance.reset(wh, T2)
    assert wh.read("fact") is None and wh.watermark(S.PIPELINE) == 0
    assert wh.read("bronze").count() == 3 and wh.read("gold_daily").count() > 0
    # new orders arrive under new ids
    later = [(40, 1, 1, 2), (41, 2, 2, 2)]
    assert etl_run.run_etl(wh, _source(spark, later), T2, with_quality=False).rows == 2
    assert wh.read("fact").count() == 2 and wh.read("bronze").count() == 5


def test_tokens_do_not_outlive_a_reset(spark):
    wh = Warehouse(spark, work_dir(spark, "test-token"))
    wh.commit([], "batch-0-9", T1, {"p": 9})
    assert wh.done("batch-0-9")
    maintenance.reset(wh, T1)
    assert not wh.done("batch-0-9")
    wh.commit([], "batch-0-9", T1, {"p": 9})
    assert wh.done("batch-0-9") and Warehouse(spark, wh.root).done("batch-0-9")


def test_watermark_table(spark):
    from cartwheel.operators import etl
    state = spark.createDataFrame([("a", 5, T1)], "PipelineName string, LastProcessedRowId long, "
                                                  "LastProcessedAt timestamp_ntz")
    assert etl.read_watermark(state, "a") == 5 and etl.read_watermark(state, "b") == 0
    batch = spark.createDataFrame([(7,), (9,)], "OrderItemId long")
    after = etl.advance_watermark(state, batch, "a", T2)
    assert [tuple(r) for r in after.collect()] == [("a", 9, T2)]
    assert etl.advance_watermark(state, batch.limit(0), "a", T2).collect() == state.collect()
    both = etl.advance_watermark(state, batch, "b", T2)
    assert sorted(tuple(r) for r in both.collect()) == [("a", 5, T1), ("b", 9, T2)]


def test_feed_reader_numbers_rows(spark):
    folder = work_dir(spark, "test-feed")
    rows = spark.range(0, 500, 1, 1).select(F.col("id").cast("string").alias("OrderRef"), F.lit(" x").alias("Sku"))
    rows.write.option("header", True).csv(folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        feed = readers.read_feed(spark, folder, ["OrderRef", "Sku"], multi_line=False)
        assert feed.rdd.getNumPartitions() > 1
        got = {r.RowNo: r.OrderRef for r in feed.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i + 2: str(i) for i in range(500)}
    assert {r.RowNo: r.OrderRef for r in readers.read_feed(spark, folder, ["OrderRef", "Sku"]).collect()} == got


def test_feed_reader_keeps_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Ref,Sku\n1,"x\ny"\n2,\n3,"say ""hi"""\n')
    (tmp_path / "b.csv").write_text('Ref,Sku\n4,"\n"\n5,z\n')
    feed = readers.read_feed(spark, str(tmp_path), ["Ref", "Sku"]).collect()
    assert sorted(r.RowNo for r in feed) == [2, 3, 4, 5, 6]
    assert {r.Ref: r.Sku for r in feed}["1"] == "x\ny" and {r.Ref: r.RowNo for r in feed}["3"] == 4


DOCUMENT = """{
  // the whitelist
  "name": "shop", "defaultSchema": "gold", "maxRows": 1000,
  "tables": [
    {"name": "Daily", "columns": [{"name": "Date", "type": "date",}, {"name": "Category", "type": "string"}]},
    {"schema": "silver", "name": "Fact", "columns": [{"name": "DateKey", "type": "int"}]},
  ],
  "fewShot": [{"question": "How much?", "sql": "SELECT 1"}]
}"""


def test_schema_document(spark, tmp_path):
    good, empty = tmp_path / "doc.json", tmp_path / "empty.json"
    good.write_text(DOCUMENT)
    empty.write_text('{"name": "x", "tables": []}')
    document = readers.read_schema_document(spark, str(good))
    assert [tuple(r) for r in readers.schema_catalogue(document).collect()] == [
        ("gold", "Daily", "Date", "date"), ("gold", "Daily", "Category", "string"),
        ("silver", "Fact", "DateKey", "int")]
    assert readers.canned_questions(document).first().question == "How much?"
    with pytest.raises(ValueError):
        readers.read_schema_document(spark, str(empty))
    with pytest.raises(Exception):
        readers.read_schema_document(spark, str(tmp_path / "none.json"))


def test_json_lines_skip_blank_lines(spark, tmp_path):
    path = tmp_path / "safety.jsonl"
    path.write_text('{"name":"a","expect":"reject","sql":"DROP TABLE x"}\n\n{"name":"b","expect":"allow","sql":"SELECT 1"}\n')
    rows = readers.read_json_lines(spark, str(path), readers.SAFETY).collect()
    assert [(r.name, r.expect) for r in rows] == [("a", "reject"), ("b", "allow")]
