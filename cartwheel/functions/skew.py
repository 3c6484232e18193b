"""Ordered per-key operators that keep working when one key holds a large part of the rows.

A plain ``Window.partitionBy(key)`` sends the whole key to one task.  Here each key is cut into chunks that follow
the order (a day, an hour, an id range).  Rows are only sorted inside a chunk; the chunks of a key are then linked
through one small row per (key, chunk).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


#: ids of one moment that stay in one chunk
IDS_PER_CHUNK = 1_000_000_000
_MINUTE = 60_000_000


def time_chunk(moment: str, ident: str, ids: int = IDS_PER_CHUNK) -> Column:
    """Chunk for rows ordered by (moment, id): the minute, and an id range for rows exactly on the minute.

    Logs with a clock are cut by minute, which bounds the chunks of a key by the calendar; dates without a time of
    day put all rows on one moment, where the order is that of the ids.
    """
    micros = F.unix_micros(F.col(moment).cast("timestamp"))
    exact = micros % _MINUTE == 0
    return F.struct(F.floor(micros / _MINUTE).alias("minute"), (~exact).alias("later"),
                    F.when(exact, F.floor(F.col(ident) / ids)).otherwise(F.lit(0)).alias("ids"))


def _join_pieces(rows: DataFrame, pieces: DataFrame, part: list[str]) -> DataFrame:
    """Rows with the one row of their piece; a null key is a key like others."""
    named = pieces.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(part)],
                          *[c for c in pieces.columns if c not in part])
    on = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(part)]
    return rows.join(named, on).drop(*[f"_of_{i}" for i in range(len(part))])


def running_total(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column, value: str,
                  out: str) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this one.

    ``chunk`` must not be null and must never fall when ``order`` rises.
    """
    return running_totals(df, key, order, chunk, {out: F.col(value)})


def running_totals(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column,
                   values: Mapping[str, Column]) -> DataFrame:
    """Several running sums, named by ``values``, from one sort and one exchange; same rule for ``chunk``."""
    names = list(values)
    cut = df.select("*", chunk.alias("_chunk"), *[value.alias(f"_v{i}") for i, value in enumerate(values.values())])
    part = [*key, "_chunk"]
    earlier = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (cut.groupBy(*part).agg(*[F.sum(f"_v{i}").alias(f"_sum{i}") for i in range(len(names))])
              .select(*part, *[F.coalesce(F.sum(f"_sum{i}").over(earlier), F.lit(0)).alias(f"_before{i}")
                               for i in range(len(names))]))
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = cut.select("*", *[F.sum(f"_v{i}").over(upto).alias(f"_inside{i}") for i in range(len(names))])
    return (_join_pieces(inside, before, part)
            .select(*df.columns, *[(F.col(f"_before{i}") + F.col(f"_inside{i}")).alias(n) for i, n in enumerate(names)]))


def previous_value(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column, value: str,
                   out: str) -> DataFrame:
    """``value`` of the row before this one in its key (null on the first row); same rule for ``chunk``."""
    cut = df.withColumn("_chunk", chunk)
    part = [*key, "_chunk"]
    last = (cut.groupBy(*part).agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
            .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*key).orderBy("_chunk"))).drop("_last"))
    inside = F.lag(F.struct(value)).over(Window.partitionBy(*part).orderBy(*order))
    return (_join_pieces(cut.withColumn("_inside", inside), last, part)
            .select(*df.columns, F.coalesce("_inside", "_carry")[value].alias(out)))


def first_claims(rows: DataFrame, key: str, order: str, taken: DataFrame | None = None) -> DataFrame:
    """For each key the ``order`` value that owns it; keys already ``taken`` are owned by -1.

    A plain minimum, so it combines before the shuffle and no key is ever gathered.
    """
    claims = rows.select(key, F.col(order).cast("long").alias("Owner"))
    if taken is not None:
        claims = claims.unionByName(taken.select(key, F.lit(-1).cast("long").alias("Owner")))
    return claims.groupBy(key).agg(F.min("Owner").alias("Owner"))
