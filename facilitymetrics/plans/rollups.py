"""Unfiltered roll-ups of the staffing table by month, state, provider and quarter.

The monthly table is the finest level; the coarser ones are sums over it.  The sum of present
values is the same in one step or two, so each is a single aggregate that leaves out the rows the
monthly table leaves out: those without id, name, state or month.  It shuffles a few rows per
task instead of every facility month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facilitymetrics.functions.timeops import month_label
from facilitymetrics.operators.ordering import ranked
from facilitymetrics.operators.select import present
from facilitymetrics.plans.summary import FACILITY_STATE, HOURS, Summary, additive_rows
from facilitymetrics.schemas import CCN


def _rolled_up(staffing: DataFrame | Summary, keys: Sequence[str]) -> DataFrame:
    """Hours by key over rows that belong to a facility month.

    Undated rows are left out inside the aggregate: a filter on the parsed month would be
    evaluated ahead of the projection, and every work date would be parsed twice.
    """
    dated_hours = F.when(F.col("month").isNotNull(), F.col(HOURS))
    return (
        present(additive_rows(staffing), *FACILITY_STATE)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum(dated_hours), F.lit(0.0)).alias(HOURS),
            F.count("month").alias("dated_rows"),
        )
        .filter(F.col("dated_rows") > 0)
        .drop("dated_rows")
    )


def _labelled(rolled_up: DataFrame) -> DataFrame:
    """Write out the month of the grouped rows (far fewer than the day rows)."""
    return rolled_up.withColumn("month", month_label(F.col("month")))


def monthly_hours(staffing: DataFrame | Summary) -> DataFrame:
    """Hours per facility and month."""
    return _labelled(_rolled_up(staffing, [*FACILITY_STATE, "month"]))


def hours_by_month(staffing: DataFrame | Summary) -> DataFrame:
    return _labelled(_rolled_up(staffing, ["month"])).orderBy("month")


def hours_by_state(staffing: DataFrame | Summary) -> DataFrame:
    return ranked(_rolled_up(staffing, ["state"]), HOURS, ["state"], ascending=True)


def hours_by_provider(staffing: DataFrame | Summary) -> DataFrame:
    keys = ["provider_name", "state"]
    return ranked(_rolled_up(staffing, keys), HOURS, keys)


# Levels of the table of all roll-ups, with the columns that each is kept by.
LEVELS: dict[str, tuple[str, ...]] = {
    "facility": (*FACILITY_STATE, "month"),
    "month": ("month",),
    "state": ("state",),
    "provider": ("provider_name", "state"),
}


def all_rollups(staffing: DataFrame | Summary) -> DataFrame:
    """Hours of all four roll-ups in one table, from one scan: grouping sets over the facility months.

    ``level`` says which roll-up a row belongs to; the columns that it is not kept by are null.  Facility months are added up
    first, so what is repeated for each grouping set is a row for each of them and not each day.
    """
    keys = LEVELS["facility"]
    months = _rolled_up(staffing, keys)
    sets = [[F.col(name) for name in names] for names in LEVELS.values()]
    # One bit for each key, set where the grouping set lacks it.
    bits = {sum(1 << (len(keys) - 1 - k) for k, name in enumerate(keys) if name not in names): level
            for level, names in LEVELS.items()}
    level = F.grouping_id(*[F.col(name) for name in keys])
    named = F.lit(None).cast("string")
    for value, name in bits.items():
        named = F.when(F.col("grouped_by") == value, name).otherwise(named)
    grouped = months.groupingSets(sets, *[F.col(name) for name in keys]).agg(
        level.alias("grouped_by"), F.sum(HOURS).alias(HOURS)
    )
    return _labelled(grouped.withColumn("level", named).drop("grouped_by")).select("level", *keys, HOURS)


def rollup_of(rollups: DataFrame, level: str) -> DataFrame:
    """One roll-up out of ``all_rollups``, as the function of that roll-up gives it."""
    names = LEVELS[level]
    rows = rollups.where(F.col("level") == level).select(*names, HOURS)
    if level == "month":
        return rows.orderBy("month")
    if level == "state":
        return ranked(rows, HOURS, ["state"], ascending=True)
    if level == "provider":
        return ranked(rows, HOURS, list(names))
    return rows


# Records of a complete quarter: a day each, as the dashboards expect.
EXPECTED_RECORDS = 91


def unexpected_records(completeness: DataFrame, expected: int = EXPECTED_RECORDS) -> DataFrame:
    """Facility quarters of ``record_completeness`` with another number of records than expected."""
    return completeness.where(F.col("record_count") != expected)


def record_completeness(staffing: DataFrame | Summary) -> DataFrame:
    """Staffing records per facility and quarter."""
    keys = [CCN, "CY_Qtr"]
    return (
        present(additive_rows(staffing), *keys)
        .groupBy(*keys)
        .agg(F.sum("record_count").alias("record_count"))
    )
