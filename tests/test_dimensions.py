from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.scalars import date_key, row_hash, ts
from cartwheel.operators import dims

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
SCHEMA = "CustomerId long, FullName string, Email string, City string"


@pytest.mark.parametrize("text,key", [("2026-05-19", 20260519), ("2026-01-01", 20260101), ("2026-12-31", 20261231),
                                      ("2000-02-29", 20000229), ("2026-05-19 23:59:59", 20260519)])
def test_date_key(spark, text, key):
    assert spark.range(1).select(date_key(ts(text))).first()[0] == key


def _versions(frame):
    return {(r.CustomerId, r.Version): r for r in frame.collect()}


def test_scd2_life_of_a_key(spark):
    one = spark.createDataFrame([(1, "A", "a@x", None), (2, "B", "b@x", "HN"), (3, "C", "c@x", "HN")], SCHEMA)
    two = spark.createDataFrame([(1, "A", "a@x", ""), (2, "B", "b@x", "HCM"), (4, "D", "d@x", None)], SCHEMA)
    first = dims.scd2_first_load(one, dims.CUSTOMER, T1)
    rows = _versions(dims.scd2_apply(first, two, dims.CUSTOMER, T2))
    assert set(rows) == {(1, 1), (2, 1), (2, 2), (3, 1), (4, 1)}  # null city equals empty city
    assert rows[2, 1].ValidTo == T2 and not rows[2, 1].IsCurrent
    assert rows[2, 2].ValidFrom == T2 and rows[2, 2].ValidTo is None and rows[2, 2].IsCurrent
    assert rows[3, 1].IsCurrent  # gone from the source, stays current
    assert rows[2, 2].CustomerKey == 2002 and rows[4, 1].CustomerKey == 4001
    assert first.columns == dims.CUSTOMER.columns


def test_scd2_same_snapshot_changes_nothing(spark):
    one = spark.createDataFrame([(1, "A", "a@x", None)], SCHEMA)
    first = dims.scd2_first_load(one, dims.CUSTOMER, T1)
    assert dims.scd2_apply(first, one, dims.CUSTOMER, T2).collect() == first.collect()


def test_scd2_closes_a_current_row_without_hash(spark):
    one = spark.createDataFrame([(1, "A", "a@x", None)], SCHEMA)
    bare = dims.scd2_first_load(one, dims.CUSTOMER, T1).withColumn("RowHash", F.lit(None).cast("string"))
    rows = _versions(dims.scd2_apply(bare, one, dims.CUSTOMER, T2))
    assert not rows[1, 1].IsCurrent and rows[1, 2].IsCurrent


def test_third_version_and_history(spark):
    frame = None
    for moment, city in ((T1, "HN"), (T2, "HCM"), (T3, "HN")):
        snap = spark.createDataFrame([(1, "A", "a@x", city)], SCHEMA)
        frame = (dims.scd2_first_load(snap, dims.CUSTOMER, moment) if frame is None
                 else dims.scd2_apply(frame, snap, dims.CUSTOMER, moment))
    history = {r.Version: r.Changed for r in dims.version_history(frame, dims.CUSTOMER).collect()}
    assert history == {1: "(new)", 2: "City", 3: "City"}


def test_as_of_join_borders(spark):
    frame = dims.scd2_first_load(spark.createDataFrame([(1, "A", "a@x", "HN")], SCHEMA), dims.CUSTOMER, T1)
    frame = dims.scd2_apply(frame, spark.createDataFrame([(1, "A", "a@x", "HCM")], SCHEMA), dims.CUSTOMER, T2)
    asked = spark.createDataFrame([(1, datetime(2023, 1, 1)), (1, T1), (1, datetime(2024, 1, 31)), (1, T2), (9, T2)],
                                  "CustomerId long, At timestamp_ntz")
    found = dims.as_of_join(asked, "At", frame, dims.CUSTOMER).orderBy("CustomerId", "At").collect()
    assert [r.CustomerKey for r in found] == [None, 1001, 1001, 1002, None]


def test_carried_as_of_equals_the_join(spark):
    """A key with very many versions, gaps, versions of no length, rows on a version's first moment, null keys."""
    import random
    from datetime import timedelta
    rng, versions, start = random.Random(3), [], datetime(2023, 12, 1)
    for key in (1, 2, 3):
        at = start
        for nr in range(2000 if key == 1 else 5):
            until = at + timedelta(minutes=rng.choice([0, 1, 7, 90]))
            versions.append((key, key * 10000 + nr, at, None if rng.random() < 0.001 and nr == 1999 else until))
            at = until + timedelta(minutes=rng.choice([0, 0, 0, 30]))
    rows = [(rng.choice([1, 1, 1, 2, 3, 4, None]), start + timedelta(minutes=rng.randrange(-500, 60000)), i % 50)
            for i in range(1500)]
    rows += [(key, at, 7) for key, _, at, _ in versions[:40]] * 2 + [(1, None, 8)]
    asked = spark.createDataFrame(rows, "CustomerId long, At timestamp_ntz, Note int")
    held = spark.createDataFrame(versions, "CustomerId long, CustomerKey long, ValidFrom timestamp_ntz, ValidTo timestamp_ntz")
    want = dims.as_of_join(asked, "At", held, dims.CUSTOMER)
    got = dims.as_of_carried(asked, "At", held, dims.CUSTOMER)
    assert got.columns == want.columns and got.count() == len(rows)
    assert got.exceptAll(want).isEmpty() and want.where("CustomerKey is not null").count() > 500
    assert dims.as_of_carried(asked.limit(0), "At", held, dims.CUSTOMER).isEmpty()
    alone = dims.as_of_carried(asked, "At", held.limit(0), dims.CUSTOMER)
    assert alone.count() == len(rows) and alone.where("CustomerKey is not null").isEmpty()


def test_hash_joins_with_a_plain_bar_and_has_a_wide_form(spark):
    rows = spark.createDataFrame([("a", "b|c"), ("a|b", "c")], "x string, y string")
    narrow = [r[0] for r in rows.select(row_hash(["x", "y"])).collect()]
    assert narrow[0] == narrow[1]
    import hashlib
    wide = rows.select(row_hash(["x", "y"], "UTF-16LE")).first()[0]
    assert wide == hashlib.sha256("a|b|c".encode("utf-16-le")).hexdigest()


def test_calendar(spark):
    rows = {r.DateKey: r for r in dims.date_dim(spark, date(2024, 2, 25), date(2024, 3, 3)).collect()}
    assert len(rows) == 8 and rows[20240229].MonthName == "February" and rows[20240229].Quarter == 1
    assert rows[20240225].DayOfWeek == 1 and rows[20240225].IsWeekend  # Sunday
    monday = {r.DateKey: r for r in dims.date_dim(spark, date(2024, 2, 25), date(2024, 3, 3), "monday").collect()}
    assert monday[20240226].DayOfWeek == 1 and monday[20240225].DayName == "Sunday"
    assert not monday[20240301].IsWeekend and monday[20240302].IsWeekend
    known = dims.date_dim(spark, date(2024, 2, 25), date(2024, 2, 28))
    assert dims.missing_days(dims.date_dim(spark, date(2024, 2, 25), date(2024, 3, 3)), known).count() == 4


def test_tables_have_the_declared_columns(spark, retail):
    from pyspark.sql import types as T
    from cartwheel import schemas as S
    from cartwheel.operators import etl, gold
    r = retail
    frames = {
        "dim_date": r.dim_date, "dim_customer": r.dim_customer, "dim_product": r.dim_product, "fact": r.fact,
        "gold_daily": gold.daily_sales_by_category(r.fact, r.dim_date, r.dim_product),
        "gold_monthly": gold.monthly_top_products(r.fact, r.dim_date, r.dim_product),
        "gold_clv": gold.customer_lifetime_value(r.fact, r.dim_date, r.dim_customer, S.AS_OF),
        "gold_mix": gold.sales_by_payment_method(r.orders), "gold_funnel": gold.order_funnel(r.orders),
        "gold_inventory": gold.product_inventory(r.fact, r.dim_product, r.products)}
    assert set(frames) == set(S.OLAP)
    for name, frame in frames.items():
        want = T.StructType.fromDDL(S.OLAP[name])
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in want], name
    bronze = etl.landed(etl.incremental_extract(r.order_items, r.orders, 0), S.AS_OF)
    want = T.StructType.fromDDL(S.BRONZE)
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in want]
