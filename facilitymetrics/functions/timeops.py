"""Work dates and month buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_workday(df: DataFrame, column: str = "WorkDate") -> Column:
    """Date of a work-day column: ``yyyyMMdd`` number or text, ISO or ``MM/dd/yyyy`` text, a date.

    Blanks around a text do not count, nor does a fraction of zero (a whole-number column that once
    held nulls often arrives as DOUBLE).  Anything that is no calendar day becomes null.  Digits are taken apart by
    arithmetic; only dates with separators are parsed as text.
    """
    day = F.col(column)
    kind = df.schema[_resolve(df, column)].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return day.cast("date")
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        day = F.when(day == F.floor(day), day).try_cast("long")
    if isinstance(kind, T.NumericType):
        return _from_digits(day.cast("long"))
    day = F.trim(day)
    slashed = F.split(day, "/")
    american = F.concat_ws("-", F.get(slashed, F.lit(2)), F.lpad(F.get(slashed, F.lit(0)), 2, "0"), F.lpad(F.get(slashed, F.lit(1)), 2, "0"))
    iso = F.when(day.contains("-"), day).when(day.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), american)
    # A number of eight digits is in range only without a sign or a point among eight characters.
    return F.when(F.length(day) == 8, F.coalesce(_from_digits(day.try_cast("int")), iso.try_cast("date"))).otherwise(
        iso.try_cast("date")
    )


def _from_digits(number: Column) -> Column:
    """Date of a whole number ``yyyyMMdd`` from year 1000 on; null if it is no day of the calendar."""
    month, in_month = F.floor(number / 100) % 100, number % 100
    first = F.when(
        number.between(1000_01_01, 9999_12_31) & month.between(1, 12),
        F.make_date(F.floor(number / 10000).cast("int"), month.cast("int"), F.lit(1)),
    )
    return F.when(in_month.between(1, F.dayofmonth(F.last_day(first))), F.date_add(first, (in_month - 1).cast("int")))


def _resolve(df: DataFrame, column: str) -> str:
    for name in df.columns:
        if name.lower() == column.lower():
            return name
    raise ValueError(f"no column {column!r} among {df.columns}")


def month_start(day: Column) -> Column:
    """First day of the month: a date, hence a four-byte grouping key."""
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    """Month as ``yyyy-MM`` text."""
    return F.date_format(day, "yyyy-MM")
