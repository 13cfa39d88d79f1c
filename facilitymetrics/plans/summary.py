"""Staffing summary: the one table that every staffing report can be computed from.

Reports take either day rows or the written summary (as ``Summary``), with the same result: they only ever add
up hours, days and records over keys that the summary keeps.  From day rows each report is a
single aggregate of its own; a job that builds several writes the summary first, so the
staffing table is read and shuffled once instead of once per report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facilitymetrics.functions.rowwise import safe_ratio
from facilitymetrics.functions.timeops import month_start, parse_workday
from facilitymetrics.schemas import CCN
from facilitymetrics.sources.sizing import MIB, input_bytes, partitions_for

FACILITY = (CCN, "provider_name")
FACILITY_STATE = FACILITY + ("state",)
SUMMARY_KEYS = FACILITY_STATE + ("CY_Qtr", "month")
HOURS = "Total_Nurse_Hrs"
MEASURES = (HOURS, "hour_days", "record_count", "employee_hrs", "contractor_hrs")
# Bytes of the plan's estimate of two summaries for each task that adds them up.
MERGE_BYTES = 16 * MIB
# Such tasks, unless the session asks for more; estimates from which on the size is taken as unknown.
MOST_PARTS, UNKNOWN_BYTES = 10_000, 1 << 50


@dataclass(frozen=True)
class Summary:
    """Says that a table is a staffing summary; any other table is taken as day rows."""

    table: DataFrame


def additive_rows(staffing: DataFrame | Summary) -> DataFrame:
    """Rows whose measures can be added up: day rows extended, a summary as it is.

    ``hour_days`` counts the days with a known total, ``record_count`` all days, and
    ``month`` is the first day of the month, null for an unreadable work date.  Columns that a
    report does not use cost nothing, since they are pruned.  Columns of day rows with these
    names play no part.
    """
    if isinstance(staffing, Summary):
        return staffing.table
    return staffing.withColumns(
        {
            "hour_days": F.col(HOURS).isNotNull().cast("int"),
            "record_count": F.lit(1),
            "month": month_start(parse_workday(staffing)),
        }
    )


def mean_daily_hours() -> Column:
    """Aggregate: mean of the known daily totals."""
    return safe_ratio(F.sum(HOURS), F.sum("hour_days"))


def staffing_summary(pbj: DataFrame) -> DataFrame:
    """Added-up hours, days and records per facility, quarter and month.

    Groups with a missing key are kept: some reports count their hours.
    """
    return (
        additive_rows(pbj)
        .groupBy(*SUMMARY_KEYS)
        .agg(*[F.sum(measure).alias(measure) for measure in MEASURES])
    )


def with_quarters_replaced(
    summary: DataFrame, fresh: DataFrame, quarters: Sequence[str | None], quarter: str = "CY_Qtr"
) -> DataFrame:
    """The summary with the rows of the touched quarters exchanged for ``fresh``, which may have none of a quarter.

    Every group belongs to one quarter, so a corrected quarter is replaced and a removed one left out without
    reading the staffing rows of the others.
    """
    named = [q for q in quarters if q is not None]
    touched = F.coalesce(F.col(quarter).isin(named), F.lit(False)) if named else F.lit(False)
    if None in quarters:
        touched = touched | F.col(quarter).isNull()
    return summary.where(~touched).unionByName(fresh)


def _merge_parts(*summaries: DataFrame) -> int:
    configured = int(summaries[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = input_bytes(*summaries)
    known = size < UNKNOWN_BYTES
    parts = min(partitions_for(size, 1, MERGE_BYTES), max(configured, MOST_PARTS)) if known else configured
    # As many parts as the summaries were made in are no parts of their own to Spark.
    return parts + 1 if parts == configured else parts


def with_rows_added(summary: DataFrame, added: DataFrame) -> DataFrame:
    """The summary after further staffing rows, given by their own summary: measures add up group by group."""
    # Dealt anew into parts by size: merged where they were made, a task would hold the groups of both and the sums at once.
    parts = _merge_parts(summary, added)
    return (
        summary.repartition(parts, *SUMMARY_KEYS)
        .unionByName(added.repartition(parts, *SUMMARY_KEYS))
        .groupBy(*SUMMARY_KEYS)
        .agg(*[F.sum(measure).alias(measure) for measure in MEASURES])
    )
