"""Dimensions: type-2 history, calendar, key lookups and as-of joins."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cartwheel.functions.scalars import date_key, day, row_hash, ts


@dataclass(frozen=True)
class Scd2:
    """Natural key, surrogate key and the columns whose change opens a new version."""
    key: str
    surrogate: str
    tracked: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, self.key, *self.tracked, "ValidFrom", "ValidTo", "IsCurrent", "Version", "RowHash"]


CUSTOMER = Scd2("CustomerId", "CustomerKey", ("FullName", "Email", "City"))
PRODUCT = Scd2("ProductId", "ProductKey", ("Sku", "Name", "Category", "Brand"))

#: surrogate keys: the first versions of a key are ``key * SHORT + version``; later ones are negative, so that no two
#: (key, version) pairs share one below LONG versions, where the load stops
SHORT, LONG = 1000, 1 << 24


def _hashed(snapshot: DataFrame, dim: Scd2) -> DataFrame:
    return snapshot.select(dim.key, *dim.tracked, row_hash(dim.tracked).alias("RowHash"))


def surrogate(key: Column, version: Column) -> Column:
    key, version = key.cast("long"), version.cast("long")
    return (F.when(version < SHORT, key * SHORT + version).when(version < LONG, -(key * LONG + version))
            .otherwise(F.raise_error(F.lit("too many versions of one key"))))


def _opened(rows: DataFrame, dim: Scd2, as_of: datetime) -> DataFrame:
    """New current versions; ``rows`` carries the version number."""
    return (rows.withColumn(dim.surrogate, surrogate(F.col(dim.key), F.col("Version")))
            .withColumn("ValidFrom", ts(as_of)).withColumn("ValidTo", F.lit(None).cast("timestamp_ntz"))
            .withColumn("IsCurrent", F.lit(True)).select(dim.columns))


def scd2_first_load(snapshot: DataFrame, dim: Scd2, as_of: datetime) -> DataFrame:
    """Version 1 of every key."""
    return _opened(_hashed(snapshot, dim).withColumn("Version", F.lit(1)), dim, as_of)


def scd2_apply(current: DataFrame, snapshot: DataFrame, dim: Scd2, as_of: datetime) -> DataFrame:
    """The dimension after a full snapshot: changed versions are closed, new or changed keys get a version.

    Keys missing from the snapshot stay current.  A current row without a hash counts as changed.
    The result holds all versions; write it to a new folder, never over the one ``current`` reads.
    """
    staged = _hashed(snapshot, dim)
    wanted = staged.select(dim.key, F.col("RowHash").alias("_hash"))
    closes = F.col("IsCurrent") & F.col("_hash").isNotNull() & ~F.col("RowHash").eqNullSafe(F.col("_hash"))
    kept = (current.join(wanted, dim.key, "left").withColumn("_closes", closes)
            .withColumn("ValidTo", F.when(F.col("_closes"), ts(as_of)).otherwise(F.col("ValidTo")))
            .withColumn("IsCurrent", F.col("IsCurrent") & ~F.col("_closes")).select(dim.columns))
    # the highest version and the current hashes of a key from one pass; a key has one current version, as a rule
    known = current.groupBy(dim.key).agg(F.max("Version").alias("_last"),
                                         F.collect_set(F.when(F.col("IsCurrent"), F.col("RowHash"))).alias("_hashes"))
    unchanged = F.coalesce(F.array_contains("_hashes", F.col("RowHash")), F.lit(False))
    fresh = (staged.join(known, dim.key, "left").where(~unchanged)
             .withColumn("Version", (F.coalesce("_last", F.lit(0)) + 1).cast("int")).drop("_last", "_hashes"))
    return kept.unionByName(_opened(fresh, dim, as_of))


def current_keys(dimension: DataFrame, dim: Scd2) -> DataFrame:
    """Natural key to the surrogate key of its current version."""
    return dimension.where("IsCurrent").select(dim.key, dim.surrogate)


def version_history(dimension: DataFrame, dim: Scd2) -> DataFrame:
    """Per version: the columns that differ from the version before it.

    Versions are numbered without gaps, so the previous one is an equi-join on (key, version) and spreads evenly.
    """
    before = dimension.select(dim.key, (F.col("Version") + 1).alias("Version"),
                              *[F.col(c).alias(f"_{c}") for c in dim.tracked], F.lit(True).alias("_known"))
    joined = dimension.join(before, [dim.key, "Version"], "left")
    changed = F.concat_ws(",", *[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in dim.tracked])
    return joined.select(dim.key, "Version", "ValidFrom", "ValidTo", "IsCurrent",
                         F.when(F.col("_known"), changed).otherwise(F.lit("(new)")).alias("Changed"))


def as_of_join(rows: DataFrame, moment: str, dimension: DataFrame, dim: Scd2) -> DataFrame:
    """Adds the surrogate key that was valid at ``moment`` (null when none was).

    An equi-join on the natural key with the validity range as a further condition; the ranges of one key never
    overlap, so each row finds one version at most.
    """
    versions = dimension.select(F.col(dim.key).alias("_key"), dim.surrogate, "ValidFrom", "ValidTo")
    at = F.col(moment)
    valid = ((F.col(dim.key) == F.col("_key")) & (at >= F.col("ValidFrom"))
             & (F.col("ValidTo").isNull() | (at < F.col("ValidTo"))))
    return rows.join(versions, valid, "left").drop("_key", "ValidFrom", "ValidTo")


#: parts that the rows of one key and hour are dealt to
AS_OF_PARTS = 8


def as_of_carried(rows: DataFrame, moment: str, dimension: DataFrame, dim: Scd2, parts: int = AS_OF_PARTS) -> DataFrame:
    """The same result as :func:`as_of_join` for keys with very many versions, where that join would try them all.

    Rows and versions are put in one order of time, and each row takes the last version before it.  A key is cut by hour,
    the rows of an hour are dealt to ``parts`` tasks that all hold its versions, and the last version of an hour is carried
    to the hours after it through one small row each.  Null keys and moments find nothing.
    """
    at, far = F.col("_at"), F.lit("9999-12-31").cast("timestamp_ntz")
    version = F.struct(F.col(dim.surrogate).alias("key"), F.col("ValidTo").alias("to"))
    keep = F.struct(*[F.col(c) for c in rows.columns])
    asked = rows.select(F.col(dim.key).alias("_key"), F.col(moment).cast("timestamp_ntz").alias("_at"), keep.alias("_row"),
                        F.pmod(F.xxhash64(*[c for c, t in rows.dtypes if "map" not in t]), F.lit(parts)).alias("_part"))
    held = dimension.where(F.col(dim.key).isNotNull() & F.col("ValidFrom").isNotNull()).select(
        F.col(dim.key).alias("_key"), F.col("ValidFrom").alias("_at"), version.alias("_version"))
    copies = held.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")))
    both = (asked.unionByName(copies, allowMissingColumns=True)
            .withColumn("_hour", F.date_trunc("hour", at)))
    ends = F.coalesce(F.col("_version.to"), far)
    here = F.last("_version", ignorenulls=True).over(
        Window.partitionBy("_key", "_hour", "_part").orderBy("_at", F.col("_row").isNotNull(), ends)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hours = (both.groupBy("_key", "_hour").agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.struct(at, ends)))
                                               .alias("_last"))
             .withColumn("_before", F.last("_last", ignorenulls=True).over(
                 Window.partitionBy("_key").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)))
             .where("_before is not null").select("_key", "_hour", "_before"))
    found = both.withColumn("_here", here).where("_row is not null").join(hours, ["_key", "_hour"], "left")
    last = F.coalesce("_here", "_before")
    valid = last["to"].isNull() | (at < last["to"])
    return found.select("_row.*", F.when(valid, last["key"]).alias(dim.surrogate))


def _calendar(days: DataFrame, first_day: str) -> DataFrame:
    d = F.col("Date")
    common = [date_key(d).alias("DateKey"), d, F.year(d).alias("Year"), F.quarter(d).alias("Quarter"),
              F.month(d).alias("Month"), F.date_format(d, "MMMM").alias("MonthName"), F.dayofmonth(d).alias("Day")]
    if first_day == "sunday":
        number = F.dayofweek(d)
        return days.select(*common, number.alias("DayOfWeek"), number.isin(1, 7).alias("IsWeekend"))
    number = F.weekday(d) + 1
    return days.select(*common, number.alias("DayOfWeek"), F.date_format(d, "EEEE").alias("DayName"),
                       number.isin(6, 7).alias("IsWeekend"))


def date_dim(spark: SparkSession, start: date, end: date, first_day: str = "sunday") -> DataFrame:
    """One row per day; ``first_day='monday'`` numbers Monday 1 and adds the day name."""
    return _calendar(spark.range(1).select(F.explode(F.sequence(day(start), day(end))).alias("Date")), first_day)


def date_dim_between(rows: DataFrame, moment: str, first_day: str = "sunday") -> DataFrame:
    """Calendar from the first to the last day found in a column."""
    ends = rows.agg(F.min(moment).cast("date").alias("a"), F.max(moment).cast("date").alias("b"))
    return _calendar(ends.select(F.explode(F.sequence("a", "b")).alias("Date")), first_day)


def missing_days(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """The days to insert: those the calendar does not have yet."""
    return wanted.join(existing.select("Date"), "Date", "left_anti").select(wanted.columns)
