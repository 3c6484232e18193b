"""What keeps driver, disk and task memory bounded when tables grow."""

import time
import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartwheel import session
from cartwheel.operators import acceptance, gold, quality
from cartwheel.plans import etl_run, registry, registry_jobs
from cartwheel.sources.warehouse import Warehouse
from cartwheel.streaming import jobs


@pytest.fixture
def tuned(spark):
    names = [*session.RUNTIME, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = {name: spark.conf.get(name, None) for name in names}
    yield session.tune(spark)
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_side_that_is_small_only_as_a_file_is_not_broadcast(tuned, tmp_path):
    tuned.range(1_000_000).selectExpr("id k", "id % 3 v").repartition(1).write.parquet(f"{tmp_path}/keys")
    keys = tuned.read.parquet(f"{tmp_path}/keys")
    size = sum(p.stat().st_size for p in (tmp_path / "keys").glob("*.parquet"))
    assert size < 10 << 20  # below Spark's usual threshold, while the hash table of its rows takes several times that
    plan = keys.withColumnRenamed("v", "w").join(keys, "k")._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan


def test_a_session_with_few_partitions_gets_more_to_merge(tuned):
    assert tuned.conf.get("spark.sql.shuffle.partitions") == "8"  # as the tests' session is made
    assert int(tuned.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= session.PARTITIONS
    assert tuned.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_rounds_of_acceptance_leave_no_copies_of_the_lines(tuned, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    at = F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")
    lines = tuned.createDataFrame([(1, 1, 4), (1, 2, 4), (2, 2, 4), (2, 3, 4), (3, 3, 4), (4, 1, 2), (5, 1, 1)],
                                  "OrderId long, ProductId long, Quantity int")
    heads = tuned.range(1, 6).select(F.col("id").alias("OrderId"), at.alias("OrderDate"))
    products = tuned.range(1, 4).select(F.col("id").alias("ProductId"), F.lit(6).alias("StockQuantity"))
    got = {r.OrderId: (r.Accepted, r.ShortProductId) for r in acceptance.accept_orders(lines, heads, products).collect()}
    assert got == {1: (True, None), 2: (False, 2), 3: (True, None), 4: (True, None), 5: (False, 1)}
    left = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert left.count("order-lines") == 1 and not {"order-open", "order-demand"} & set(left)


def test_jobs_number_the_lines_once(retail):
    items = registry_jobs._items(retail)
    assert "Window" not in items._jdf.queryExecution().sparkPlan().toString()
    assert items.count() == retail.order_items.count()


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {path for folder in folders for path in Path(folder.toString()).rglob("shuffle_*")}


def _left(spark, before):
    """Shuffle files that are still there a while after; Spark deletes them in a thread of its own."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_the_suite_computes_its_tables_once_and_drops_them(tuned, retail, tmp_path, monkeypatch):
    seen, real = {}, quality.run_suite
    monkeypatch.setattr(session, "work_dir", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    monkeypatch.setattr(quality, "run_suite", lambda tables, *rest: seen.update(
        {name: table._jdf.queryExecution().sparkPlan().toString() for name, table in tables.items()}) or real(tables, *rest))
    told = {row.TestName: row.ActualValue for row in registry._suite(retail).collect()}
    for name in ("fact", "dim_customer"):
        assert "Join" not in seen[name] and "Window" not in seen[name]
    assert told["fact_row_count_nonzero"] == str(retail.faulty_star["fact"].count())
    assert not list(tmp_path.iterdir())


def test_an_error_in_a_column_fails_only_the_tests_that_read_it(tuned, retail, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    wrong = F.when(F.col("OrderItemId") % 2 == 0, F.raise_error(F.lit("no price"))).otherwise(F.col("UnitPrice"))
    star = retail.faulty_star | {"fact": retail.faulty_star["fact"].withColumn("UnitPrice", wrong.cast("decimal(18,2)"))}
    monkeypatch.setitem(retail.__dict__, "faulty_star", star)
    told = {row.TestName: row.Message for row in registry._suite(retail).collect()}
    [(name, message)] = [(name, message) for name, message in told.items() if message]
    assert name == "fact_unitprice_lineTotal_consistency" and "no price" in message


def test_a_suite_leaves_no_shuffle_files(tuned):
    fact = tuned.range(20_000).selectExpr("id % 15000 OrderItemId", "id % 7000 CustomerKey")
    tests = [t for t in quality.suite() if t.name in ("fact_no_duplicate_orderitemid", "fact_customerkey_resolves")]
    before = _shuffle_files(tuned)
    rows = quality.run_suite({"fact": fact, "dim_customer": tuned.range(6999).withColumnRenamed("id", "CustomerKey")},
                             tests, datetime(2000, 1, 1)).collect()
    assert sorted(r.ActualValue for r in rows) == ["2", "5000"]
    assert not _left(tuned, before)
    assert tuned.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_staged_tables_leave_no_shuffle_files(tuned, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "RELEASE_EVERY", 0)
    wh, before = Warehouse(tuned, str(tmp_path)), _shuffle_files(tuned)
    counts = tuned.range(20_000).selectExpr("id % 7000 k").groupBy("k").count()
    wh.stage("plain", counts)
    assert not _left(tuned, before)
    wh.stage_all({"even": counts, "other": counts}, "replace")
    assert not _left(tuned, before)


def test_tables_are_staged_one_after_the_other(tuned, tmp_path, monkeypatch):
    wh, open_, most = Warehouse(tuned, str(tmp_path)), [], []

    def stage(table, frame, mode):
        open_.append(table)
        most.append(len(open_))
        time.sleep(0.1)
        open_.remove(table)

    monkeypatch.setattr(wh, "stage", stage)
    wh.stage_all(dict.fromkeys("abc"), "replace")
    assert most == [1, 1, 1]


def test_monthly_lists_shuffle_no_texts_and_keep_texts_apart(tuned):
    keys = [(1001, 1, "a", "Pen", None), (1002, 1, "a", "Pen", None), (1003, 1, "b", "Pen", None), (1004, 1, "a", "Ink", "X"),
            (2001, 2, "c", "Cup", "Y"), (2002, 2, "c", "Cup", "Y"), (-1, None, "n", "None", "Z")]
    product = tuned.createDataFrame(keys, "ProductKey long, ProductId long, Sku string, Name string, Category string")
    rows = [(key, 1, revenue) for key, revenue in ((1001, 2), (1002, 3), (1003, 5), (1004, 5), (2001, 4), (2002, 4), (2002, 1),
                                                   (-1, 1), (None, 99), (7, 99))]
    versions = tuned.createDataFrame(rows, "ProductKey long, Quantity long, Revenue long").selectExpr(
        "2024 Year", "1 Month", "ProductKey", "Quantity", "cast(Revenue as decimal(28,2)) Revenue")
    best = gold.best_of_months(versions, product, 6)
    got = [(r.RankInMonth, r.ProductId, r.Sku, r.ProductName, r.Category, r.TotalQuantity, int(r.TotalRevenue))
           for r in best.orderBy("RankInMonth").collect()]
    assert got == [(1, 2, "c", "Cup", "Y", 3, 9), (2, 1, "a", "Ink", "X", 1, 5), (3, 1, "a", "Pen", None, 2, 5),
                   (4, 1, "b", "Pen", None, 1, 5), (5, None, "n", "None", "Z", 1, 1)]
    dealt = [line for line in best._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in line]
    assert dealt and not any("Sku" in line or "Name" in line or "Category" in line for line in dealt)


@pytest.fixture
def lines_left(retail, tmp_path, monkeypatch):
    """How many tables of numbered lines there are when a load runs; the loads themselves are left out."""
    seen = []
    for module in (session, registry_jobs):
        monkeypatch.setattr(module, "work_dir", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")

    def told(*args, **more):
        seen.append(len(list(tmp_path.glob("order-items-*"))))

    monkeypatch.setattr(jobs, "run_etl_stream", told)
    monkeypatch.setattr(etl_run, "run_etl", told)
    return lambda: (seen, len(list(tmp_path.glob("order-items-*"))))


def test_a_stream_keeps_its_lines_once(tuned, retail, lines_left, tmp_path):
    registry_jobs._stream(retail, "stream")
    assert lines_left() == ([1, 0], 0)
    assert tuned.read.parquet(f"{next(tmp_path.glob('stream-*'))}/items").count() == retail.order_items.count()


def test_batches_drop_the_numbered_lines(tuned, retail, lines_left):
    registry_jobs._batches(retail, "batches")
    assert lines_left() == ([1, 1], 0)
