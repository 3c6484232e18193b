"""The load: dimensions, bronze, fact, gold, quality and run log, over a warehouse folder."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from cartwheel import schemas as S
from cartwheel.functions.scalars import month_of, ts
from cartwheel.operators import dims, etl, gold, gold_state, quality
from cartwheel.sources.warehouse import Staged, Warehouse, literal_rows

RUN_LOG = T.StructType([
    T.StructField("RunId", T.StringType()), T.StructField("PipelineName", T.StringType()),
    T.StructField("StartedAt", T.TimestampNTZType()), T.StructField("CompletedAt", T.TimestampNTZType()),
    T.StructField("DurationMs", T.LongType()), T.StructField("RowsProcessed", T.LongType()),
    T.StructField("Watermark", T.LongType()), T.StructField("Status", T.StringType()),
    T.StructField("ErrorMessage", T.StringType())])


@dataclass(frozen=True)
class Source:
    """Frames of the source system at the time of a run."""
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame | None = None


def refresh_dimensions(wh: Warehouse, source: Source, as_of: datetime) -> None:
    """New versions of the three dimensions, committed together."""
    frames = {}
    for table, dim, snapshot in (("dim_customer", dims.CUSTOMER, source.customers),
                                 ("dim_product", dims.PRODUCT, source.products)):
        current = wh.read(table)
        frames[table] = (dims.scd2_first_load(snapshot, dim, as_of) if current is None
                         else dims.scd2_apply(current, snapshot, dim, as_of))
    calendar, known = dims.date_dim_between(source.orders, "OrderDate"), wh.read("dim_date")
    frames["dim_date"] = calendar if known is None else known.unionByName(dims.missing_days(calendar, known))
    wh.commit(wh.stage_all(frames, "replace"), f"dims-{uuid.uuid4().hex}", as_of)


@dataclass(frozen=True)
class BatchResult:
    fact: DataFrame | None
    rows: int
    watermark: int


def load_batch(wh: Warehouse, lines: DataFrame, source: Source, as_of: datetime, token: str,
               low: int | None = None, high: int | None = None) -> BatchResult:
    """Land extracted lines and turn them into facts; bronze, fact, quarantine and mark commit together.

    ``low`` / ``high`` bound the ids of the batch: only that id range of bronze and fact is read to find lines that were
    landed or loaded before.  A line that bronze holds and the fact lacks (after a reset, or because a lookup failed
    before) becomes a fact now.  A token that was committed before makes this a no-op.
    """
    if wh.done(token):
        return BatchResult(None, 0, wh.watermark(S.PIPELINE))
    def in_range(frame: DataFrame) -> DataFrame:
        return frame.where(F.col("OrderItemId").between(low, high)) if high is not None else frame

    known, held = wh.read("bronze"), wh.read("fact")
    if known is not None:  # a batch above all that is landed, the usual case, has nothing to be compared with
        known = None if in_range(known).isEmpty() else in_range(known)
    landed_keys = lines.select("OrderItemId").where(F.lit(False)) if known is None else known
    fresh = etl.bronze_new_rows(lines, landed_keys, "OrderItemId")
    bronze = wh.stage("bronze", etl.landed(fresh, as_of).sortWithinPartitions("OrderItemId"))
    # what follows reads the landed folder: a lost executor costs a re-read, not a re-extract.  Rows are counted in
    # the files too, since metrics taken while writing count repeated tasks twice
    rows = wh.open(bronze)
    landed = rows.count()
    top = high if high is not None else rows.agg(F.max("OrderItemId")).first()[0]
    mark = max(wh.watermark(S.PIPELINE), top or 0)
    if known is not None:
        again = known.join(lines.select("OrderItemId"), "OrderItemId", "left_semi")
        if held is not None:
            again = again.join(in_range(held).select("OrderItemId"), "OrderItemId", "left_anti")
        if not again.isEmpty():
            rows = rows.unionByName(_with_orders(again, source.orders))
            landed = rows.count()
    if not landed:
        if mark > wh.watermark(S.PIPELINE):
            wh.commit([], token, as_of, {S.PIPELINE: mark})
        return BatchResult(None, 0, mark)
    staged = [bronze, *_facts(wh, rows, as_of)]
    fact = wh.open(staged[1])
    loaded = fact.count()
    wh.commit(staged, token, as_of, {S.PIPELINE: mark})
    return BatchResult(fact if loaded else None, loaded, mark)


def _with_orders(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Landed lines with what their order says now, for those that had no order when they landed."""
    now = orders.select("OrderId", F.col("CustomerId").alias("_customer"), F.col("OrderDate").alias("_date"))
    found = rows.join(now, "OrderId", "left")
    return found.withColumn("CustomerId", F.coalesce("CustomerId", "_customer")).withColumn(
        "OrderDate", F.coalesce("OrderDate", "_date")).select(rows.columns)


def _facts(wh: Warehouse, rows: DataFrame, as_of: datetime) -> list[Staged]:
    """Staged facts of landed lines, and the lines that are not in quarantine yet and still lack something."""
    customer_keys = dims.current_keys(wh.read("dim_customer"), dims.CUSTOMER)
    product_keys = dims.current_keys(wh.read("dim_product"), dims.PRODUCT)
    resolved = (rows.join(customer_keys, "CustomerId", "left").join(product_keys, "ProductId", "left")
                .withColumn("DateKey", etl.date_key(F.col("OrderDate"))))
    fact = etl.silver_fact(resolved, as_of).withColumn("MonthKey", month_of(F.col("DateKey")))
    staged = [wh.stage("fact", fact, partition="MonthKey")]
    if wh.open(staged[0]).count() < rows.count():  # the lookups run a second time only when they lost something
        lost, before = etl.fact_quarantine(resolved), wh.read("quarantine")
        if before is not None:
            lost = lost.join(before.select("OrderItemId", "Reason"), ["OrderItemId", "Reason"], "left_anti").select(
                lost.columns)
        staged.append(wh.stage("quarantine", lost))
    return staged


def redrive(wh: Warehouse, source: Source, as_of: datetime) -> BatchResult:
    """Facts for quarantined lines whose order and dimension rows have arrived since; the rest stays where it is."""
    waiting, held, mark = wh.read("quarantine"), wh.read("fact"), wh.watermark(S.PIPELINE)
    if waiting is None:
        return BatchResult(None, 0, mark)
    rows = wh.read("bronze").join(waiting.select("OrderItemId"), "OrderItemId", "left_semi")
    if held is not None:
        rows = rows.join(held.select("OrderItemId"), "OrderItemId", "left_anti")
    staged = _facts(wh, _with_orders(rows, source.orders), as_of)
    fact = wh.open(staged[0])
    loaded = fact.count()
    if loaded:
        wh.commit(staged, f"redrive-{uuid.uuid4().hex}", as_of)
    return BatchResult(fact if loaded else None, loaded, mark)


def refresh_gold(wh: Warehouse, source: Source, as_of: datetime, incremental: bool = False) -> None:
    """Gold over the fact when it changed, and gold over the current orders and stock on every run.

    Each gold commit tells the last fact commit it covers, so a run that died between the two is made up for by the next
    one.  With ``incremental`` the facts committed since then are folded in: days they touch are made anew, their fold
    per month and product is appended to ``gold_product_months``, and months and customers follow from that.  Without
    it, or when the fact was replaced meanwhile, everything comes from the whole fact.
    """
    upto, covered = wh.last_commit("fact"), wh.covered("gold")
    fact, days = wh.read("fact"), wh.read("dim_date")
    customer, product = wh.read("dim_customer"), wh.read("dim_product")
    frames = {"gold_mix": gold.sales_by_payment_method(source.orders),
              "gold_funnel": gold.order_funnel(source.orders)}
    months, staged = wh.read("gold_product_months"), []
    if fact is not None and (upto > covered or months is None):
        new = wh.since("fact", covered) if incremental and months is not None else None
        fold = gold_state.product_months(fact if new is None else new, days)
        staged.append(wh.stage("gold_product_months", fold, "replace" if new is None else "append", "MonthKey"))
        added = wh.open(staged[0])
        months = added if new is None else months.unionByName(added)
        if new is None:
            frames |= {"gold_daily": gold.daily_sales_by_category(fact, days, product),
                       "gold_orders": gold_state.order_mix(fact, days, product),
                       "gold_monthly": gold_state.monthly_top_products(months, product),
                       "gold_clv": gold.customer_lifetime_value(fact, days, customer, as_of)}
        else:
            frames |= {"gold_daily": gold.daily_sales_incremental(wh.read("gold_daily"), new, fact, days, product),
                       "gold_orders": gold_state.order_mix_incremental(wh.read("gold_orders"), new, fact, days, product),
                       "gold_monthly": gold_state.monthly_incremental(wh.read("gold_monthly"), months, added, product),
                       "gold_clv": gold_state.lifetime_value_incremental(
                           wh.read("gold_clv"), new, wh.read("fact", covered), days, customer, as_of)}
    if fact is not None:
        frames["gold_inventory"] = gold.product_inventory(months, product, source.products)
    stamped = {name: frame.withColumn("RefreshedAt", ts(as_of)) for name, frame in frames.items()}
    staged += wh.stage_all(stamped, "replace")
    wh.commit(staged, f"gold-{uuid.uuid4().hex}", as_of, covers={"gold": upto})


STAR_TABLES = ("fact", "dim_customer", "dim_product", "dim_date", "gold_daily", "gold_inventory", "gold_mix")


def run_quality(wh: Warehouse, as_of: datetime, tables: dict[str, DataFrame] | None = None, tests=None,
                batch: int | None = None) -> Staged:
    """Append the result rows of a quality run and return their folder."""
    tables = tables or {name: frame for name in STAR_TABLES if (frame := wh.read(name)) is not None}
    results = quality.run_suite(tables, tests or quality.suite(), as_of)
    staged = wh.stage("dq_results", results.withColumn("BatchId", F.lit(batch).cast("long")).coalesce(1))
    wh.commit([staged], f"dq-{uuid.uuid4().hex}", as_of)
    return staged


def write_run_log(wh: Warehouse, started: datetime, took_ms: int, rows: int, mark: int, as_of: datetime,
                  error: str | None = None) -> None:
    row = [(uuid.uuid4().hex, S.PIPELINE, started, as_of, took_ms, rows, mark,
            "Failed" if error else "Succeeded", error)]
    staged = wh.stage("run_log", literal_rows(wh.spark, row, RUN_LOG))
    wh.commit([staged], f"run-{uuid.uuid4().hex}", as_of)


def run_etl(wh: Warehouse, source: Source, as_of: datetime, with_quality: bool = True,
            incremental_gold: bool = False) -> BatchResult:
    """One batch run from the watermark: what arrived since the last run, then gold, quality and the run log."""
    with logged_run(wh, as_of) as done:
        refresh_dimensions(wh, source, as_of)
        mark = wh.watermark(S.PIPELINE)
        top = source.items.agg(F.max("OrderItemId")).first()[0] or 0
        lines = etl.incremental_extract(source.items.where(F.col("OrderItemId") <= top), source.orders, mark)
        # the mark is part of the token: a retry of the same range is the same batch
        result = (load_batch(wh, lines, source, as_of, f"batch-{mark}-{top}", mark + 1, top) if top > mark
                  else BatchResult(None, 0, mark))
        done(result.rows, result.watermark)
        finish_run(wh, source, as_of, with_quality, incremental_gold)
    return result


@contextmanager
def logged_run(wh: Warehouse, as_of: datetime) -> Iterator[Callable[[int, int], None]]:
    """A row in the run log for what happens inside, also when it fails; the function given tells rows and watermark.

    A run that fails after its batch was committed shows the rows it loaded.  The error itself goes on to the caller.
    """
    clock, told = time.monotonic(), [0, None]

    def done(rows: int, mark: int) -> None:
        told[:] = rows, mark

    def write(error: str | None) -> None:
        mark = wh.watermark(S.PIPELINE) if told[1] is None else told[1]
        write_run_log(wh, as_of, int((time.monotonic() - clock) * 1000), told[0], mark, as_of, error)

    try:
        yield done
    except Exception as error:
        try:
            write(f"{type(error).__name__}: {error}")
        except Exception as second:  # the log may be what is broken: the first error is the one to tell
            error.add_note(f"and the run log could not be written: {second}")
        raise
    write(None)


def finish_run(wh: Warehouse, source: Source, as_of: datetime, with_quality: bool = True,
               incremental_gold: bool = False) -> None:
    refresh_gold(wh, source, as_of, incremental_gold)
    if with_quality:
        run_quality(wh, as_of)
