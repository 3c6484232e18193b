"""Column helpers shared by the operators; all of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, functions as F


def ts(value: datetime | str) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def date_key(moment: Column) -> Column:
    """yyyymmdd as an int; the time of day is ignored."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def month_of(key: Column) -> Column:
    """yyyymm of a yyyymmdd key, the partition value of the fact."""
    return F.floor(key / 100).cast("int")


def row_hash(columns: Sequence[str], charset: str | None = None) -> Column:
    """SHA-256 hex over the tracked columns joined by a bar, null as ''.

    ``charset='UTF-16LE'`` hashes the two-byte form that wide SQL strings have.
    """
    joined = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.sha2(F.encode(joined, charset) if charset else joined, 256)


def narrow(amount: Column) -> Column:
    """An amount about to be divided and rounded.

    The width of the dividend decides how many digits Spark keeps in the quotient: from 38 digits only 6 decimals,
    from 24 digits 16, so that rounding never sees a value which the division moved.
    """
    return amount.cast("decimal(24,2)")


def average(total: Column, count: Column) -> Column:
    """total / count to two decimals, halves up, null on a zero count."""
    return (narrow(total) / F.nullif(count, F.lit(0))).cast("decimal(18,2)")


def whole_average(total: Column, count: Column) -> Column:
    """Sum of whole numbers / count with 18 decimals, 0 on a zero count."""
    ratio = total.cast("decimal(20,0)") / F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    return F.coalesce(ratio, F.lit(0))


def label(code: Column, names: Mapping[int, str], other: Column | None = None) -> Column:
    chain = F
    for value, name in names.items():
        chain = chain.when(code == value, F.lit(name))
    return chain.otherwise(code.cast("string") if other is None else other)


def contains_text(column: Column, needle: str) -> Column:
    """Case-insensitive substring test, as the default collation of the source does it."""
    return F.contains(F.lower(column), F.lit(needle.strip().lower()))


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def grouped_by_dots(amount: Column) -> Column:
    """Whole units with '.' between thousands, rounded half away from zero."""
    return F.translate(F.format_number(F.round(amount, 0), 0), ",", ".")


def vnd_label(amount: Column) -> Column:
    return F.concat(grouped_by_dots(amount), F.lit(" ₫"))


def compact_label(amount: Column, currency: bool = False) -> Column:
    """K / M / B / T label with one decimal; plain digits with a decimal comma below a thousand."""
    size = F.abs(amount)
    suffix = " ₫" if currency else ""

    def scaled(unit: int, letter: str) -> Column:
        tenths = F.round(narrow(amount) / F.lit(unit), 1).cast("decimal(38,1)")
        return F.concat(tenths.cast("string"), F.lit(letter + suffix))

    plain = F.regexp_replace(F.regexp_replace(amount.cast("decimal(18,2)").cast("string"), r"\.?0+$", ""), r"\.", ",")
    return (F.when(size >= 10**12, scaled(10**12, "T")).when(size >= 10**9, scaled(10**9, "B"))
            .when(size >= 10**6, scaled(10**6, "M")).when(size >= 1000, scaled(1000, "K"))
            .otherwise(F.concat(plain, F.lit(suffix))))


def _ratio(part: Column, whole: Column) -> Column:
    return narrow(part) * 100 / narrow(F.nullif(whole, F.lit(0)))


def percent_half_even(part: Column, whole: Column) -> Column:
    """part / whole in percent with one decimal, ties to the even digit, 0 for an empty whole."""
    return F.coalesce(F.bround(_ratio(part, whole), 1), F.lit(0)).cast("decimal(18,1)")


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent with one decimal, ties away from zero, 0 for an empty whole."""
    return F.coalesce(F.round(_ratio(part, whole), 1), F.lit(0)).cast("decimal(18,1)")
