"""Grouped and whole-table aggregates with the package's rules for missing values.

Groups whose key is missing are left out.  All aggregates have a map-side partial step, so
a hot key crosses the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facilitymetrics.operators.select import present


def sum_or_zero(value: str) -> Column:
    """Sum of the present values; 0.0 when there is none."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def mean_or_zero_if_no_rows(value: str) -> Column:
    """Mean of the present values; 0.0 for no rows, null for rows without any value."""
    return F.when(F.count(F.lit(1)) == 0, F.lit(0.0)).otherwise(F.avg(value))


def group_mean(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return present(df, *keys).groupBy(*keys).agg(F.avg(value).alias(name))


def group_size(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return present(df, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def deduplicated(df: DataFrame) -> DataFrame:
    """Distinct full rows (null equals null); copies collapse before the shuffle."""
    return df.dropDuplicates()
