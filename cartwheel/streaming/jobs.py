"""Structured Streaming forms of the load, settlement, notification and quality jobs.

All of them read a folder of parquet files as a stream, run with ``availableNow`` and commit each micro-batch through
the warehouse under a token made of the job and the batch number, so a batch that is replayed after a failure is
recognised.  State between batches lives in committed tables, not in one task's memory per key: a key that gets a
third of all events is combined before it is shuffled, as in the batch form.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from cartwheel import schemas as S
from cartwheel.operators import etl, outbox, payments, quality
from cartwheel.plans import etl_run
from cartwheel.session import tune
from cartwheel.sources.warehouse import Warehouse


def _drain(spark: SparkSession, folder: str, schema: T.StructType, checkpoint: str,
           handle: Callable[[DataFrame, int, str], None], files_per_batch: int | None = None) -> StreamingQuery:
    """Run ``handle`` over everything that is new in the folder, then stop.

    It gets the batch, its number, and a name of the batch for tokens: the number alone starts over with every new
    checkpoint, so the name begins with the id that the checkpoint keeps.
    """
    kept: list[str] = []

    def named(batch: DataFrame, number: int) -> None:
        tune(batch.sparkSession)  # a stream runs in a session of its own, without adaptive execution
        if not kept:
            kept.append(spark.read.json(f"{checkpoint}/metadata").first()["id"])
        handle(batch, number, f"{kept[0]}-{number}")

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.parquet(folder).writeStream.foreachBatch(named).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


# ---------------------------------------------------------------- load
def run_etl_stream(wh: Warehouse, items_folder: str, source: etl_run.Source, as_of: datetime, checkpoint: str,
                   files_per_batch: int | None = None, check_batches: bool = False,
                   with_quality: bool = False) -> int:
    """One run of the load over new files of order lines; returns the facts loaded.

    Keyed on files and not on ids: a line that arrives late with a low id is still loaded.
    """
    loaded, mark = 0, 0

    def handle(batch: DataFrame, number: int, name: str) -> None:
        nonlocal loaded, mark
        ends = batch.agg(F.min("OrderItemId"), F.max("OrderItemId")).first()
        if ends[0] is None:
            return
        lines = etl.incremental_extract(batch, source.orders, ends[0] - 1)
        result = etl_run.load_batch(wh, lines, source, as_of, f"etl-stream-{name}", ends[0], ends[1])
        loaded, mark = loaded + result.rows, max(mark, result.watermark)
        if check_batches and result.fact is not None:
            check_batch(wh, result.fact, as_of, number)

    with etl_run.logged_run(wh, as_of) as done:
        etl_run.refresh_dimensions(wh, source, as_of)
        _drain(wh.spark, items_folder, S.ORDER_ITEMS, checkpoint, handle, files_per_batch)
        done(loaded, mark)
        etl_run.finish_run(wh, source, as_of, with_quality, incremental_gold=True)
    return loaded


def check_batch(wh: Warehouse, fact: DataFrame, as_of: datetime, number: int) -> None:
    """Quality tests of the star on the rows of one micro-batch."""
    tables = {"fact": fact} | {name: wh.read(name) for name in ("dim_customer", "dim_product", "dim_date")}
    tests = [t for t in quality.suite() if t.table in (None, *tables)]
    etl_run.run_quality(wh, as_of, tables, tests, number)


# ---------------------------------------------------------------- settlement
def run_settlement_stream(wh: Warehouse, callbacks_folder: str, payments_: DataFrame, as_of: datetime,
                          checkpoint: str) -> None:
    """Outcome of every new callback; a ref that was paid in an earlier batch stays paid.

    The memory between batches is one small row per ref and batch: when it was first paid and first failed.
    """
    def handle(batch: DataFrame, number: int, name: str) -> None:
        token = f"settle-{name}"
        if wh.done(token):
            return
        marks = wh.read("settle_marks")
        refs = batch.select("Ref").distinct()
        earlier = marks.join(refs, "Ref", "left_semi") if marks is not None else None
        outcome = wh.stage("settlement", payments.settle(batch, payments_, earlier))
        kept = wh.stage("settle_marks", payments.settle_marks(batch, payments_))
        wh.commit([outcome, kept], token, as_of)

    _drain(wh.spark, callbacks_folder, S.CALLBACKS, checkpoint, handle)


# ---------------------------------------------------------------- outbox
_RETRY = ["OutboxId", "OrderId", "EventType", "Payload", "ProcessedAt", "Attempts", "LastError", "Tried"]


def _dispatch(wh: Warehouse, due: DataFrame, orders: DataFrame, deliveries: DataFrame, as_of: datetime,
              token: str) -> int:
    """One round: send what is due, keep what may be tried again, log what is finished.  Returns the retries left."""
    round_ = wh.stage("outbox_rounds", outbox.mark(due, orders, deliveries, as_of))
    after = wh.open(round_)
    again = after.where(F.col("ProcessedAt").isNull() & (F.col("Attempts") < S.OUTBOX_MAX_ATTEMPTS))
    rest = wh.stage("outbox_retry", again, "replace")
    done = wh.stage("outbox_done", after.where(F.col("ProcessedAt").isNotNull()
                                               | (F.col("Attempts") >= S.OUTBOX_MAX_ATTEMPTS)))
    wh.commit([rest, done], token, as_of)
    return wh.open(rest).count()


def run_outbox_stream(wh: Warehouse, outbox_folder: str, orders: DataFrame, deliveries: DataFrame, as_of: datetime,
                      checkpoint: str) -> None:
    """Send new messages; failed ones come back with the next batch and, after the last one, until they are
    delivered or have used up their attempts (so that many rounds at most)."""
    def with_retries(fresh: DataFrame | None) -> DataFrame | None:
        waiting = wh.read("outbox_retry")
        if fresh is None or waiting is None:
            return fresh if waiting is None else waiting
        return fresh.unionByName(waiting)

    def handle(batch: DataFrame, number: int, name: str) -> None:
        if not wh.done(f"outbox-{name}"):
            fresh = outbox.pending(batch).withColumn("Tried", F.lit(0)).select(_RETRY)
            _dispatch(wh, with_retries(fresh), orders, deliveries, as_of, f"outbox-{name}")

    _drain(wh.spark, outbox_folder, S.OUTBOX, checkpoint, handle)
    for _ in range(S.OUTBOX_MAX_ATTEMPTS):
        waiting = with_retries(None)
        if waiting is None or not _dispatch(wh, waiting, orders, deliveries, as_of, "outbox-retry"):
            break
