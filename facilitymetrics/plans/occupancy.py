"""Report tables on facilities, beds and occupancy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facilitymetrics.functions.rowwise import safe_ratio
from facilitymetrics.functions.textfmt import fixed, percent, stars
from facilitymetrics.operators.aggs import group_mean, group_size, mean_or_zero_if_no_rows
from facilitymetrics.operators.joins import with_state_name
from facilitymetrics.operators.ordering import first_row, ranked, ranked_rows
from facilitymetrics.operators.select import EVERYTHING, FacilityFilter
from facilitymetrics.plans.facility_staffing import facility_staffing
from facilitymetrics.plans.summary import FACILITY, FACILITY_STATE
from facilitymetrics.schemas import CCN


def occupancy_kpis(provider: DataFrame, choice: FacilityFilter = EVERYTHING) -> DataFrame:
    """Provider count (by name) and the means over the selected facility rows."""
    return choice.full_scope(provider).agg(
        F.count_distinct("provider_name").alias("providers"),
        mean_or_zero_if_no_rows("occupancy_rate").alias("avg_occupancy"),
        mean_or_zero_if_no_rows("certified_beds").alias("avg_certified_beds"),
        mean_or_zero_if_no_rows("average_residents_per_day").alias("avg_residents"),
    )


def occupancy_kpi_text(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        F.col("providers").cast("string").alias("providers"),
        percent(F.col("avg_occupancy")).alias("avg_occupancy"),
        fixed(F.col("avg_certified_beds"), 1).alias("avg_certified_beds"),
        fixed(F.col("avg_residents"), 1).alias("avg_residents"),
    )


def provider_detail(provider: DataFrame, choice: FacilityFilter = EVERYTHING) -> DataFrame:
    """The first selected facility with its own occupancy and ratings as text."""
    shown = (
        "provider_name", "state", "ownership_type", "occupancy_rate", "overall_rating",
        "staffing_rating",
    )
    first = first_row(choice.full_scope(provider).select(CCN, *shown), [CCN, *shown])
    return with_state_name(first).select(
        "provider_name",
        "state_name",
        "ownership_type",
        percent(F.col("occupancy_rate"), 2).alias("occupancy"),
        stars(F.col("overall_rating")).alias("overall_rating"),
        stars(F.col("staffing_rating")).alias("staffing_rating"),
    )


def occupancy_by_provider(
    provider: DataFrame, choice: FacilityFilter = EVERYTHING
) -> DataFrame:
    means = group_mean(
        choice.chart_scope(provider), ["provider_name"], "occupancy_rate", "occupancy_rate"
    )
    return ranked(means, "occupancy_rate", ["provider_name"])


def beds_by_provider(provider: DataFrame, choice: FacilityFilter = EVERYTHING) -> DataFrame:
    means = group_mean(
        choice.chart_scope(provider), ["provider_name"], "certified_beds", "certified_beds"
    )
    return ranked(means, "certified_beds", ["provider_name"])


def providers_by_state(provider: DataFrame, choice: FacilityFilter = EVERYTHING) -> DataFrame:
    """Facility rows (not distinct facilities) per state."""
    sizes = group_size(choice.chart_scope(provider), ["state"], "count")
    return ranked(sizes, "count", ["state"])


def facility_analysis(
    pbj: DataFrame, provider: DataFrame, choice: FacilityFilter = EVERYTHING
) -> DataFrame:
    """Occupancy against nurse hours per resident, with the state of either source.

    ``state_x`` is the facility's state, ``state_y`` the one on its staffing rows.
    """
    facilities = choice.full_scope(provider)
    staffing = facility_staffing(pbj, facilities, FACILITY_STATE).withColumnRenamed(
        "state", "state_y"
    )
    return (
        facilities.select(
            *FACILITY,
            F.col("state").alias("state_x"),
            "occupancy_rate",
            "average_residents_per_day",
        )
        .join(staffing, list(FACILITY), "inner")
        .withColumn(
            "nurse_hours_per_resident",
            safe_ratio("avg_total_nurse_hrs", "average_residents_per_day"),
        )
    )


def occupancy_ranking(provider: DataFrame, choice: FacilityFilter = EVERYTHING) -> DataFrame:
    rows = choice.full_scope(provider).select("provider_name", "state", "occupancy_rate")
    return ranked_rows(rows, "occupancy_rate", ["provider_name", "state"])
