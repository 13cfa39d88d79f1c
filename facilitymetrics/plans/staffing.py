"""Report tables on nurse hours: averages, employee/contractor mix, hours per resident."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facilitymetrics.functions.rowwise import (
    finite_or_null,
    ratio_if_positive,
    safe_ratio,
    share_or_null,
    share_or_zero,
)
from facilitymetrics.functions.textfmt import (
    grouped,
    or_not_available,
    percent,
    ratio_to_one,
)
from facilitymetrics.operators.aggs import group_mean, sum_or_zero
from facilitymetrics.operators.joins import of_selected, with_state_name
from facilitymetrics.operators.ordering import ranked
from facilitymetrics.operators.reshape import labelled_hours
from facilitymetrics.operators.select import EVERYTHING, FacilityFilter
from facilitymetrics.plans.facility_staffing import facility_staffing
from facilitymetrics.plans.summary import FACILITY, HOURS, Summary, additive_rows
from facilitymetrics.schemas import CCN


def facility_analysis(
    pbj: DataFrame | Summary, provider: DataFrame, choice: FacilityFilter = EVERYTHING
) -> DataFrame:
    """Selected facilities with their mean daily nurse hours, total and per resident."""
    facilities = choice.full_scope(provider)
    per_resident = safe_ratio("avg_total_nurse_hrs", "average_residents_per_day")
    return (
        facilities.select(
            *FACILITY, "state", "ownership_type", "occupancy_rate", "average_residents_per_day"
        )
        .join(facility_staffing(pbj, facilities), list(FACILITY), "inner")
        .withColumn("nurse_hours_per_resident", finite_or_null(per_resident))
    )


def hours_per_resident_by_state(analysis: DataFrame) -> DataFrame:
    """Unweighted mean of the facilities' ratios; takes the rows of ``facility_analysis``."""
    means = group_mean(
        analysis, ["state"], "nurse_hours_per_resident", "nurse_hours_per_resident"
    )
    return ranked(means, "nurse_hours_per_resident", ["state"])


def _pairs(
    pbj: DataFrame | Summary,
    provider: DataFrame,
    choice: FacilityFilter,
    with_owners: bool = False,
) -> DataFrame:
    """One row per (id, name) of staffing or facility rows, with sums of both, for the ids of the selection.

    Staffing and facility rows are stacked and grouped together, so both tables are read once, no join is
    needed and nothing is fanned out by repeated facility rows.  A mean over the joined rows is
    a sum of products of such sums.  A group counts as joined when it has rows of both tables and both keys; groups
    without a key are kept, since their hours count in the totals of a selected id.

    For a narrower selection day rows are matched to its ids beforehand, which costs a second look at the
    facilities and saves grouping the rest.
    """
    facilities = choice.full_scope(provider)
    days = additive_rows(pbj)
    if choice != EVERYTHING and not isinstance(pbj, Summary):
        days = of_selected(days, facilities)
    inverse_residents = finite_or_null(safe_ratio(F.lit(1.0), "average_residents_per_day"))
    stacked = days.select(
        *FACILITY, HOURS, "hour_days", "employee_hrs", "contractor_hrs", F.lit(1).alias("staffing_row")
    ).unionByName(
        facilities.select(
            *FACILITY, "state", "ownership_type", "occupancy_rate", F.lit(1).alias("facility_row"),
            inverse_residents.alias("inverse"),
        ),
        allowMissingColumns=True,
    )
    sums = [
        F.sum(HOURS).alias("hours"),
        F.sum("hour_days").alias("hour_days"),
        F.sum("employee_hrs").alias("employee_hours"),
        F.sum("contractor_hrs").alias("contractor_hours"),
        F.count("staffing_row").alias("staffing_rows"),
        F.count("facility_row").alias("facility_rows"),
        F.count("inverse").alias("resident_rows"),
        F.sum("inverse").alias("inverse_residents"),
        F.count("occupancy_rate").alias("occupancy_rows"),
        F.sum("occupancy_rate").alias("occupancy_total"),
    ]
    if with_owners:
        # Texts are gathered from grouped rows: a minimum or a set of them over day rows would sort these.
        owners = ("state", "ownership_type")
        finer = stacked.groupBy(*FACILITY, *owners).agg(*sums)
        names = [name for name in finer.columns if name not in (*FACILITY, *owners)]
        first = F.array_min(F.collect_set(F.when(F.col("facility_rows") > 0, F.struct(*_missing_last(*owners)))))
        groups = finer.groupBy(*FACILITY).agg(first.alias("first_facility"), *[F.sum(name).alias(name) for name in names])
    else:
        groups = stacked.groupBy(*FACILITY).agg(*sums)
    chosen = F.max("facility_rows").over(Window.partitionBy(CCN)) > 0
    joined = (F.col("staffing_rows") > 0) & (F.col("facility_rows") > 0)
    for key in FACILITY:
        joined = joined & F.col(key).isNotNull()
    return groups.withColumns(
        {"mean_hours": safe_ratio("hours", "hour_days"), "chosen": chosen, "joined": joined}
    ).where("chosen")


def _missing_last(*names: str) -> list[Column]:
    """Fields that make the smallest struct the first row with missing values last."""
    flags = [[F.col(name).isNull().alias(f"{name}_missing"), F.col(name)] for name in names]
    return [field for pair in flags for field in pair]


def _joined_means() -> dict[str, Column]:
    """Means over the joined rows, 0.0 where there is no value."""

    def mean(total: Column, rows: Column) -> Column:
        both = [F.sum(F.when(F.col("joined"), value)) for value in (total, rows)]
        return F.coalesce(safe_ratio(*both), F.lit(0.0))

    hours = F.col("mean_hours")
    return {
        "avg_nurse_hours": mean(
            hours * F.col("facility_rows"),
            F.when(hours.isNotNull(), F.col("facility_rows")),
        ),
        "avg_nurse_hours_per_resident": mean(
            hours * F.col("inverse_residents"),
            F.when(hours.isNotNull(), F.col("resident_rows")),
        ),
        "avg_occupancy": mean(F.col("occupancy_total"), F.col("occupancy_rows")),
    }


def _with_mix(totals: DataFrame) -> DataFrame:
    employee, contractor = F.col("total_employee_hrs"), F.col("total_contractor_hrs")
    whole = employee + contractor
    return totals.withColumns(
        {
            "total_nursing_hrs": whole,
            "contractor_hours_pct": share_or_null(contractor, employee),
            "employee_contractor_ratio": ratio_if_positive(employee, contractor),
            "employee_pct": share_or_zero(employee, whole),
            "contractor_pct": share_or_zero(contractor, whole),
        }
    )


def staffing_kpis(
    pbj: DataFrame | Summary, provider: DataFrame, choice: FacilityFilter = EVERYTHING
) -> DataFrame:
    """One row of indicators for the selection; providers are counted by name over all its facilities."""
    means = _joined_means()
    name = F.when(F.col("facility_rows") > 0, F.col("provider_name"))
    measured = _pairs(pbj, provider, choice).agg(
        F.count_distinct(name).alias("providers"),
        *[mean.alias(title) for title, mean in means.items()],
        sum_or_zero("employee_hours").alias("total_employee_hrs"),
        sum_or_zero("contractor_hours").alias("total_contractor_hrs"),
    )
    return _with_mix(measured)


def staffing_kpi_text(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        F.col("providers").cast("string").alias("providers"),
        grouped(F.col("avg_nurse_hours"), 1).alias("avg_nurse_hours"),
        grouped(F.col("avg_nurse_hours_per_resident"), 2).alias("avg_nurse_hours_per_resident"),
        percent(F.col("avg_occupancy")).alias("avg_occupancy"),
        grouped(F.col("total_employee_hrs"), 0).alias("total_employee_hrs"),
        grouped(F.col("total_contractor_hrs"), 0).alias("total_contractor_hrs"),
        or_not_available(ratio_to_one(F.col("employee_contractor_ratio"))).alias(
            "employee_contractor_ratio"
        ),
        or_not_available(percent(F.col("contractor_hours_pct"))).alias("contractor_hours_pct"),
    )


def staffing_mix(
    pbj: DataFrame | Summary, provider: DataFrame, choice: FacilityFilter = EVERYTHING
) -> DataFrame:
    """Employee and contractor hours of the selection as two labelled rows."""
    by_facility = additive_rows(pbj).groupBy(CCN).agg(
        F.sum("employee_hrs").alias("employee_hours"),
        F.sum("contractor_hrs").alias("contractor_hours"),
    )
    totals = of_selected(by_facility, choice.full_scope(provider)).agg(
        sum_or_zero("employee_hours").alias("total_employee_hrs"),
        sum_or_zero("contractor_hours").alias("total_contractor_hrs"),
    )
    return labelled_hours(totals)


def provider_detail(
    pbj: DataFrame | Summary, provider: DataFrame, choice: FacilityFilter = EVERYTHING
) -> DataFrame:
    """Name, state and owner of the first joined facility beside the selection's averages."""
    pairs = _pairs(pbj, provider, choice, with_owners=True)
    means = _joined_means()
    first = F.min(F.when(F.col("joined"), F.struct(*FACILITY, "first_facility")))
    one = (
        pairs.agg(first.alias("first"), *[mean.alias(name) for name, mean in means.items()])
        .filter(F.col("first").isNotNull())
        .select("first.provider_name", "first.first_facility.*", *means)
    )
    return with_state_name(one).select(
        "provider_name",
        "state_name",
        "ownership_type",
        grouped(F.col("avg_nurse_hours"), 1).alias("avg_nurse_hours"),
        grouped(F.col("avg_nurse_hours_per_resident"), 2).alias("avg_nurse_hours_per_resident"),
        percent(F.col("avg_occupancy")).alias("avg_occupancy"),
    )
