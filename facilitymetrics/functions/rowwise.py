"""Null-aware arithmetic across the columns of one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _listed(names: tuple[str, ...], pattern: str, separator: str) -> str:
    """SQL text repeating a pattern for each column name."""
    return separator.join(pattern.format(f"`{name}`") for name in names)


def strict_sum(*names: str) -> Column:
    """Left-to-right sum; one missing part makes the total missing."""
    return F.expr(_listed(names, "{}", " + "))


def lenient_sum(*names: str) -> Column:
    """Left-to-right sum as double in which a missing part counts as 0.0."""
    return F.expr(_listed(names, "coalesce({}, 0D)", " + "))


def missing_count(*names: str) -> Column:
    """How many of the columns are null in this row."""
    return F.expr(_listed(names, "int({} IS NULL)", " + "))


def row_max(*names: str) -> Column:
    """Largest present value; null when there is none."""
    return F.expr(f"greatest({_listed(names, '{}', ', ')})")


def row_min(*names: str) -> Column:
    """Smallest present value; null when there is none."""
    return F.expr(f"least({_listed(names, '{}', ', ')})")


def row_range(*names: str) -> Column:
    """Largest minus smallest present value; 0 with one value, null with none."""
    return row_max(*names) - row_min(*names)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient that is null, not an error, for a zero divisor (in ANSI mode too)."""
    return F.try_divide(numerator, denominator)


def finite_or_null(value: Column) -> Column:
    """The value, or null where it is infinite or not a number."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def share_or_null(part: Column, other: Column) -> Column:
    """``part`` out of ``part + other``; null when both are 0."""
    return F.when((part != 0) | (other != 0), safe_ratio(part, part + other))


def share_or_zero(part: Column, whole: Column) -> Column:
    """``part`` out of ``whole``; 0.0 unless the whole is positive."""
    return F.when(whole > 0, safe_ratio(part, whole)).otherwise(F.lit(0.0))


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    """Quotient, null unless the divisor is positive."""
    return F.when(denominator > 0, safe_ratio(numerator, denominator))
