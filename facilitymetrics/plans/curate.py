"""Refined to curated: type boundary, dedup, derived columns, consistent names.

Derived columns are computed after the dedup, so its shuffle carries input columns only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from facilitymetrics.functions.rowwise import (
    lenient_sum,
    missing_count,
    row_max,
    row_min,
    row_range,
    safe_ratio,
    strict_sum,
)
from facilitymetrics.operators.aggs import deduplicated
from facilitymetrics.operators.reshape import renamed
from facilitymetrics.schemas import (
    CONTRACTOR_HOURS,
    CYCLE_DEFICIENCIES,
    EMPLOYEE_HOURS,
    EMPLOYEE_NURSE_HOURS,
    NURSE_HOURS,
    PBJ,
    PROVIDER_INFO,
    QUALITY,
    QUARTER_SCORES,
    REFINED,
    RENAMES,
    STATE_AVERAGES,
)
from facilitymetrics.sources.clustering import clustered_distinct
from facilitymetrics.sources.conform import conform


def derive_pbj(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "Total_Nurse_Hrs": strict_sum(*NURSE_HOURS),
            "Total_emp_Nurse_Hrs": strict_sum(*EMPLOYEE_NURSE_HOURS),
            "employee_hrs": strict_sum(*EMPLOYEE_HOURS),
            "contractor_hrs": strict_sum(*CONTRACTOR_HOURS),
        }
    ).withColumns(
        {
            "RN_Percentage": safe_ratio("Hrs_RN", "Total_Nurse_Hrs"),
            "Emp_Nurse_Percentage": safe_ratio("Hrs_RN_emp", "Total_emp_Nurse_Hrs"),
        }
    )


def derive_provider_info(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "occupancy_rate", safe_ratio("average_residents_per_day", "certified_beds")
    )


def derive_quality(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "missing_quarter_count": missing_count(*QUARTER_SCORES),
            "sum_of_available_quarterly_scores": lenient_sum(*QUARTER_SCORES),
            "max_quarterly_measure_score": row_max(*QUARTER_SCORES),
            "min_quarterly_measure_score": row_min(*QUARTER_SCORES),
            "quarterly_score_range": row_range(*QUARTER_SCORES),
        }
    )


def derive_state_averages(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "all_cycle_total_health_deficiencies": lenient_sum(*CYCLE_DEFICIENCIES),
            "total_health_deficiencies_range": row_range(*CYCLE_DEFICIENCIES),
        }
    )


DERIVE: dict[str, Callable[[DataFrame], DataFrame]] = {
    PBJ: derive_pbj,
    PROVIDER_INFO: derive_provider_info,
    QUALITY: derive_quality,
    STATE_AVERAGES: derive_state_averages,
}


def _named(refined: DataFrame, dataset: str, strict: bool) -> DataFrame:
    return renamed(conform(refined, REFINED[dataset]), RENAMES[dataset], strict)


def curate(refined: DataFrame, dataset: str, strict: bool = False) -> DataFrame:
    """Curated form of a refined table.

    Rows are compared after the type boundary, so rows that differ only by NaN and null, or by texts that are
    no number, are one.
    """
    return DERIVE[dataset](deduplicated(_named(refined, dataset, strict)))


def curate_clustered(
    refined: DataFrame,
    dataset: str,
    partition_by: Sequence[str],
    strict: bool = False,
    observed: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, bool]:
    """Curated form whose rows lie together by ``partition_by``, and whether they do.

    The one exchange of whole rows serves deduplication and the write.  Curated names count.  ``observed`` is put
    around the refined table where it is read in full.
    """

    def named(table: DataFrame) -> DataFrame:
        return _named(table, dataset, strict)

    whole = (lambda _: named(observed(refined))) if observed else None
    distinct = clustered_distinct(named(refined), partition_by, whole) if partition_by else None
    if distinct is not None:
        return DERIVE[dataset](distinct), True
    return DERIVE[dataset](deduplicated(whole(refined) if whole else named(refined))), False


def refine_state_averages(raw: DataFrame) -> DataFrame:
    """Refined state averages: the raw CSV rows without copies."""
    return deduplicated(raw)
