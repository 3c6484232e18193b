"""What a failed run, a new checkpoint, a reset and late reference rows must not lose."""

import hashlib
import hmac
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cartwheel import schemas as S
from cartwheel.functions import skew
from cartwheel.operators import dims, payments
from cartwheel.plans import etl_run, maintenance
from cartwheel.session import work_dir
from cartwheel.sources.warehouse import Warehouse
from cartwheel.streaming import jobs
from test_jobs import LINES, T1, T2, _source


def test_gold_after_a_run_that_died_before_gold(spark, monkeypatch):
    wh = Warehouse(spark, work_dir(spark, "test-gold-retry"))
    etl_run.run_etl(wh, _source(spark, LINES[:1]), T1, with_quality=False, incremental_gold=True)
    real = etl_run.refresh_gold
    monkeypatch.setattr(etl_run, "refresh_gold", lambda *a, **k: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        etl_run.run_etl(wh, _source(spark, LINES[:3]), T1, with_quality=False, incremental_gold=True)
    monkeypatch.setattr(etl_run, "refresh_gold", real)
    # the retry finds no new rows, but gold is behind the fact
    assert etl_run.run_etl(wh, _source(spark, LINES[:3]), T2, with_quality=False, incremental_gold=True).rows == 0
    assert wh.read("gold_daily").agg(F.sum("TotalRevenue")).first()[0] == 7


def test_new_checkpoint_loads_new_files(spark):
    base = work_dir(spark, "test-checkpoint")
    wh = Warehouse(spark, f"{base}/w")
    _source(spark, LINES[:1]).items.coalesce(1).write.parquet(f"{base}/one")
    _source(spark, LINES[1:3]).items.coalesce(1).write.parquet(f"{base}/two")
    assert jobs.run_etl_stream(wh, f"{base}/one", _source(spark, LINES), T1, f"{base}/c1") == 1
    assert jobs.run_etl_stream(wh, f"{base}/two", _source(spark, LINES), T2, f"{base}/c2") == 2
    assert wh.read("fact").count() == 3


def test_reload_after_reset(spark):
    wh = Warehouse(spark, work_dir(spark, "test-reload"))
    etl_run.run_etl(wh, _source(spark, LINES[:3]), T1, with_quality=False)
    wh.commit([], "settle-x-0", T1, {"other": 1})
    maintenance.reset(wh, T1)
    assert wh.done("settle-x-0")
    assert etl_run.run_etl(wh, _source(spark, LINES[:3]), T2, with_quality=False).rows == 3
    assert wh.read("fact").count() == 3 and wh.read("bronze").count() == 3


def test_orderless_lines_wait_in_quarantine(spark):
    wh = Warehouse(spark, work_dir(spark, "test-orderless"))
    source = _source(spark, [*LINES[:1], (15, 77, 1, 2), LINES[3]])
    assert etl_run.run_etl(wh, source, T1, with_quality=False).rows == 1
    lost = {r.OrderItemId: r.Reason for r in wh.read("quarantine").collect()}
    assert lost == {15: "unknown order", 30: "unknown product"} and wh.watermark(S.PIPELINE) == 30
    assert etl_run.redrive(wh, source, T2).rows == 0
    more = source.orders.where("OrderId = 1").withColumn("OrderId", F.lit(77).cast("long"))
    late = etl_run.Source(source.customers, source.products, source.orders.unionByName(more), source.items)
    assert etl_run.redrive(wh, late, T2).rows == 1
    assert etl_run.redrive(wh, late, T2).rows == 0
    assert sorted(r.OrderItemId for r in wh.read("fact").collect()) == [10, 15]
    etl_run.refresh_gold(wh, late, T2)
    assert wh.read("gold_daily").agg(F.sum("TotalRevenue")).first()[0] == 4


def test_a_range_of_copies_moves_the_mark(spark):
    wh = Warehouse(spark, work_dir(spark, "test-copies"))
    source = _source(spark, LINES[:2])
    etl_run.run_etl(wh, source, T1, with_quality=False)
    lines = etl_run.etl.incremental_extract(source.items, source.orders, 0)
    assert etl_run.load_batch(wh, lines, source, T1, "again", 1, 50).rows == 0
    assert wh.watermark(S.PIPELINE) == 50


def test_broken_log_is_not_an_empty_one(spark):
    wh = Warehouse(spark, work_dir(spark, "test-log"))
    assert wh.watermark("x") == 0
    spark.range(1).selectExpr("cast(id as string) v").write.text(f"{wh.root}/commits")
    with pytest.raises(Exception, match='(?i)parquet|footer'):
        Warehouse(spark, wh.root).watermark("x")


def test_surrogates_never_meet(spark):
    pairs = spark.range(1, 40).crossJoin(spark.range(1, 2500).withColumnRenamed("id", "v"))
    keys = pairs.select(dims.surrogate(F.col("id"), F.col("v")).alias("s"))
    assert keys.distinct().count() == pairs.count()
    now = dims.scd2_first_load(spark.createDataFrame([(1, "a", "b", "c"), (2, "a", "b", "c")],
                               "CustomerId long, FullName string, Email string, City string"), dims.CUSTOMER, T1)
    at = now.withColumn("Version", F.when(F.col("CustomerId") == 1, 1000).otherwise(F.col("Version")))
    moved = spark.createDataFrame([(1, "z", "b", "c"), (2, "a", "b", "c")],
                                  "CustomerId long, FullName string, Email string, City string")
    current = dims.current_keys(dims.scd2_apply(at, moved, dims.CUSTOMER, T2), dims.CUSTOMER).collect()
    assert len({r.CustomerKey for r in current}) == 2


def test_null_keys_stay(spark):
    rows = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7)], "k string, t int, v int")
    chunk = F.col("t")
    assert skew.running_total(rows, ["k"], ["t"], chunk, "v", "s").count() == 3
    before = {(r.k, r.t): r.p for r in skew.previous_value(rows, ["k"], ["t"], chunk, "v", "p").collect()}
    assert before == {(None, 1): None, (None, 2): 5, ("a", 1): None}


def test_long_secrets_and_plain_signs(spark):
    row = spark.createDataFrame([({"vnp_OrderInfo": "Pay (A)! *x", "vnp_Amount": "5"},)], "p map<string,string>")
    text = row.select(payments.canonical_vnpay(F.col("p"))).first()[0]
    assert text == "vnp_Amount=5&vnp_OrderInfo=Pay+(A)!+*x"
    for bits, secret in ((256, "s" * 65), (512, "t" * 200), (256, "short")):
        got = spark.range(1).select(payments.hmac_hex(F.lit("message"), secret, bits)).first()[0]
        assert got == hmac.new(secret.encode(), b"message", getattr(hashlib, f"sha{bits}")).hexdigest()
