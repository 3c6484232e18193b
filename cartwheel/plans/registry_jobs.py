"""Registered queries that run whole jobs: they write tables in the shared work folder and return what was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from cartwheel import schemas as S
from cartwheel.operators import feeds
from cartwheel.plans import etl_run, maintenance
from cartwheel.session import dropped, released, work_dir, written
from cartwheel.sources import readers
from cartwheel.sources.retail import Retail
from cartwheel.sources.warehouse import Warehouse
from cartwheel.streaming import jobs

LOADS = ((1, S.FIRST_LOAD), (2, S.SECOND_LOAD))


def _source(r: Retail, load: int, items: DataFrame | None = None) -> etl_run.Source:
    return etl_run.Source(r.customer_snapshot(load), r.product_snapshot(load), r.orders, items)


def _items(r: Retail) -> DataFrame:
    """The numbered order lines as a table: numbering takes a sort of all lines, and a job reads them several times."""
    items = written(r.spark, r.order_items.select(S.ORDER_ITEMS.fieldNames()), "order-items")
    released(r.spark)
    return items


def _items_of(r: Retail, load: int, items: DataFrame | None = None) -> DataFrame:
    items = r.order_items if items is None else items
    wanted = r.orders_in_loads.where(F.col("Load") == load).select("OrderId")
    return items.join(wanted, "OrderId", "left_semi").select(S.ORDER_ITEMS.fieldNames())


def _stream(r: Retail, name: str, check: bool = False) -> Warehouse:
    """Two drops of order lines, each followed by a run of the streaming load."""
    base = work_dir(r.spark, name)
    wh, items = Warehouse(r.spark, f"{base}/tables"), _items(r)
    for load, as_of in LOADS:
        _items_of(r, load, items).write.mode("append").parquet(f"{base}/items")
        released(r.spark)
        if load == LOADS[-1][0]:  # all lines have arrived in the folder of the stream
            dropped(r.spark, items)
        jobs.run_etl_stream(wh, f"{base}/items", _source(r, load), as_of, f"{base}/checkpoint", check_batches=check)
    return wh


def stream_etl_fact(r: Retail) -> DataFrame:
    return _stream(r, "etl-stream").read("fact").drop("EtlLoadedAt", "MonthKey")


def stream_dq(r: Retail) -> DataFrame:
    return _stream(r, "dq-stream", check=True).read("dq_results").select("BatchId", "TestName", "Status", "ActualValue")


def stream_settlement(r: Retail) -> DataFrame:
    """Callbacks in two drops, the lower sequence numbers first."""
    base = work_dir(r.spark, "settlement")
    wh = Warehouse(r.spark, f"{base}/tables")
    top = r.callbacks.agg(F.max("Seq")).scalar()
    for later in (False, True):
        part = r.callbacks.where((F.col("Seq") * 2 >= top) == F.lit(later)).select(S.CALLBACKS.fieldNames())
        part.write.mode("append").parquet(f"{base}/callbacks")
        jobs.run_settlement_stream(wh, f"{base}/callbacks", r.payments, S.AS_OF, f"{base}/checkpoint")
    return wh.read("settlement")


def stream_outbox(r: Retail) -> DataFrame:
    base = work_dir(r.spark, "outbox")
    wh = Warehouse(r.spark, f"{base}/tables")
    r.outbox.select(S.OUTBOX.fieldNames()).write.parquet(f"{base}/outbox")
    jobs.run_outbox_stream(wh, f"{base}/outbox", r.orders, r.delivery_log, S.AS_OF, f"{base}/checkpoint")
    return wh.read("outbox_done").select("OutboxId", "OrderId", "Attempts", "ProcessedAt", "LastError")


def _batches(r: Retail, name: str) -> Warehouse:
    """Two batch runs from the watermark: the second finds the lines of the second drop only."""
    wh, items = Warehouse(r.spark, work_dir(r.spark, name)), _items(r)
    etl_run.run_etl(wh, _source(r, 1, _items_of(r, 1, items)), S.FIRST_LOAD, with_quality=False)
    etl_run.run_etl(wh, _source(r, 2, items), S.SECOND_LOAD, with_quality=False)
    dropped(r.spark, items)
    return wh


def run_log(r: Retail) -> DataFrame:
    return _batches(r, "run-log").read("run_log").select("PipelineName", "RowsProcessed", "Watermark", "Status",
                                                         "CompletedAt")


def fact_compaction_stats(r: Retail) -> DataFrame:
    """Whether the rows survive and the files become fewer (file counts depend on the machine, so not shown)."""
    stats = maintenance.compact_fact(_batches(r, "compaction"), S.AS_OF)
    before = stats.where("Stage = 'before'").select(F.col("Files").alias("b"), F.col("TotalRows").alias("RowsBefore"))
    after = stats.where("Stage = 'after'").select(F.col("Files").alias("a"), F.col("TotalRows").alias("RowsAfter"))
    both = before.withColumn("k", F.lit(1)).join(after.withColumn("k", F.lit(1)), "k")
    return both.select("RowsBefore", "RowsAfter", (F.col("a") <= F.col("b")).alias("FewerFiles"))


def feed_file_customers(r: Retail) -> DataFrame:
    """The customer feed as CSV files in row order, read back and loaded; some names hold a line break."""
    path = work_dir(r.spark, "customer-feed")
    broken = F.when((F.col("RowNo") % 19 == 2) & (F.trim("FullName") != ""), F.concat("FullName", F.lit("\nII")))
    feed = r.customer_feed.withColumn("FullName", F.coalesce(broken, "FullName"))
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    feed.repartitionByRange("RowNo").sortWithinPartitions("RowNo").drop("RowNo").write.options(**keep).csv(path)
    loaded = readers.read_feed(r.spark, path, [c for c in feed.columns if c != "RowNo"])
    return feeds.load_customers(loaded, r.known_emails).accepted


def question_file(r: Retail) -> DataFrame:
    """The asked texts as a line-JSON question set, read back with its declared schema."""
    path = work_dir(r.spark, "questions")
    r.table("events").select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("difficulty"),
                             F.col("props").alias("question")).write.json(path)
    return readers.read_json_lines(r.spark, path, readers.QUESTIONS)


FRAMES: dict[str, Callable[[Retail], DataFrame]] = {
    "stream_etl_fact": stream_etl_fact, "stream_dq": stream_dq, "stream_settlement": stream_settlement,
    "stream_outbox": stream_outbox, "run_log": run_log, "fact_compaction_stats": fact_compaction_stats,
    "feed_file_customers": feed_file_customers, "question_file": question_file,
}
