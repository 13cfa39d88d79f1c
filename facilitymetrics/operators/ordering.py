"""Sorting with missing values last, and the first row of a selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = "__row_spread"


def _value_order(value: str, ascending: bool) -> Column:
    column = F.col(value)
    return column.asc_nulls_last() if ascending else column.desc_nulls_last()


def ranked(
    df: DataFrame, value: str, ties: Sequence[str], ascending: bool = False
) -> DataFrame:
    """Order grouped rows by a value, missing last, equal values by their (unique) keys."""
    return df.orderBy(_value_order(value, ascending), *[F.asc(tie) for tie in ties])


def ranked_rows(
    df: DataFrame, value: str, ties: Sequence[str], ascending: bool = False
) -> DataFrame:
    """``ranked`` for plain rows, which may agree in the value and in all tie-breakers.

    A row number as the last key gives the range partitioning distinct keys, so a
    value shared by a third of the rows is split over tasks instead of filling one.
    """
    return (
        df.withColumn(_SPREAD, F.monotonically_increasing_id())
        .orderBy(
            _value_order(value, ascending),
            *[F.asc_nulls_last(tie) for tie in ties],
            F.asc(_SPREAD),
        )
        .drop(_SPREAD)
    )


def first_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest row by the keys, missing last; a top-1 per task, never a full sort."""
    return df.orderBy(*[F.asc_nulls_last(key) for key in keys]).limit(1)
