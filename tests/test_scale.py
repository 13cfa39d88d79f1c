"""Plans and results under conditions of a large, skewed table.

One facility holds a third of all staffing rows, a third of the rows have no id, and one
facility is repeated in the master table.  Results are compared with plain Python, with
broadcast joins on and off.
"""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from facilitymetrics.operators.joins import of_selected
from facilitymetrics.operators.select import FacilityFilter
from facilitymetrics.plans import occupancy, rollups, staffing, summary
from facilitymetrics.plans.facility_staffing import facility_staffing
from facilitymetrics.schemas import CCN
from facilitymetrics.sources.sizing import input_bytes, partitions_for, sized_tasks

ROWS = 6000
FOR_PROFIT = FacilityFilter(owner="For profit")


def _day(i):
    ccn = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"f{i % 50}"
    name = "HOT" if ccn == "hot" else f"NAME {i % 50}"
    hours = None if i % 11 == 0 else float(i % 97)
    return (ccn, name, "AL" if i % 2 else "AK", 20241001 + i % 28, "2024Q4", hours,
            float(i % 7), float(i % 5))


def _facility(i):
    ccn, name = ("hot", "HOT") if i % 3 == 0 else (f"f{i % 50}", f"NAME {i % 50}")
    if i == 1:
        ccn = None
    return (ccn, name, "AL" if i % 2 else "AK", "For profit" if i % 4 else "Non profit",
            float(i % 9), float(i % 6), i)


@pytest.fixture(scope="module")
def days(spark):
    columns = (
        f"{CCN} string, provider_name string, state string, WorkDate int, CY_Qtr string, "
        "Total_Nurse_Hrs double, employee_hrs double, contractor_hrs double"
    )
    return spark.createDataFrame([_day(i) for i in range(ROWS)], columns).repartition(6)


@pytest.fixture(scope="module")
def facilities(spark):
    columns = (
        f"{CCN} string, provider_name string, state string, ownership_type string, "
        "average_residents_per_day double, occupancy_rate double, certified_beds int"
    )
    return spark.createDataFrame([_facility(i) for i in range(90)], columns).repartition(3)


@pytest.fixture(params=["broadcast", "shuffled"])
def joins(request, spark):
    if request.param == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _mean(values):
    values = [value for value in values if value is not None]
    return sum(values) / len(values) if values else None


def _expected(choice):
    chosen = [_facility(i) for i in range(90)]
    chosen = [f for f in chosen if choice.owner in (None, f[3])]
    ids = {f[0] for f in chosen}
    selected = [d for d in map(_day, range(ROWS)) if d[0] in ids]
    groups = defaultdict(list)
    for d in selected:
        if d[0] is not None:
            groups[d[:2]].append(d[5])
    means = {key: _mean(values) for key, values in groups.items()}
    joined = [(f, means[f[:2]]) for f in chosen if f[:2] in means]
    return selected, means, joined


@pytest.mark.parametrize("choice", [FacilityFilter(), FOR_PROFIT], ids=["all", "owner"])
def test_results_under_skew(days, facilities, joins, choice):
    selected, means, joined = _expected(choice)
    chosen = choice.full_scope(facilities)

    assert of_selected(days, chosen).count() == len(selected)

    found = facility_staffing(days, chosen).collect()
    assert {tuple(row[:2]): row[2] for row in found} == pytest.approx(means)

    analysis = staffing.facility_analysis(days, facilities, choice)
    assert analysis.count() == len(joined)

    kpis = staffing.staffing_kpis(days, facilities, choice).first()
    ratios = [hours / f[4] if f[4] else None for f, hours in joined]
    assert kpis["avg_nurse_hours"] == pytest.approx(_mean([hours for _, hours in joined]))
    assert kpis["avg_nurse_hours_per_resident"] == pytest.approx(_mean(ratios))
    assert kpis["avg_occupancy"] == pytest.approx(_mean([f[5] for f, _ in joined]))
    assert kpis["total_employee_hrs"] == sum(d[6] for d in selected)
    assert kpis["total_contractor_hrs"] == sum(d[7] for d in selected)

    mix = {row["Staff Type"]: row["Hours"] for row in
           staffing.staffing_mix(days, facilities, choice).collect()}
    assert mix == {
        "Employee": sum(d[6] for d in selected), "Contractor": sum(d[7] for d in selected),
    }


def test_ranking_keeps_every_row_of_a_hot_value(spark):
    rows = spark.range(3000).select(
        F.lit("SAME").alias("provider_name"),
        F.lit("AL").alias("state"),
        F.when(F.col("id") % 3 > 0, F.lit(0.5)).alias("occupancy_rate"),
    )
    ranked = occupancy.occupancy_ranking(rows)
    assert ranked.count() == 3000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = ranked.groupBy(F.spark_partition_id()).count()
        assert sizes.agg(F.max("count")).first()[0] < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins(days, facilities, joins):
    for df in (
        staffing.staffing_kpis(days, facilities),
        staffing.provider_detail(days, facilities),
        occupancy.facility_analysis(days, facilities),
        staffing.staffing_mix(days, facilities),
    ):
        assert "CartesianProduct" not in _plan(df)
        assert "BroadcastNestedLoopJoin" not in _plan(df)


@pytest.fixture(scope="module")
def stored(spark, days, facilities, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    days.write.parquet(f"{root}/days")
    facilities.write.parquet(f"{root}/facilities")
    return spark.read.parquet(f"{root}/days"), spark.read.parquet(f"{root}/facilities")


def test_semi_join_goes_below_the_aggregate_only_when_broadcast(stored, joins):
    days, facilities = stored
    plan = _plan(facility_staffing(days, FOR_PROFIT.full_scope(facilities)))
    if joins == "broadcast":
        assert plan.index("partial_sum") < plan.index("BroadcastHashJoin")
    else:
        assert plan.index("SortMergeJoin") < plan.index("partial_sum")


def test_filters_and_columns_reach_the_scan(stored):
    days, facilities = stored
    chosen = FacilityFilter(state="AL", owner="For profit").full_scope(facilities)
    plan = _plan(occupancy.occupancy_ranking(chosen))
    assert "EqualTo(state,AL)" in plan and "EqualTo(ownership_type,For profit)" in plan
    plan = _plan(rollups.hours_by_state(days))
    assert "IsNotNull(provider_name)" in plan
    assert "employee_hrs" not in plan.split("ReadSchema:")[1]


def test_staffing_table_is_read_once_for_the_kpis(stored):
    days, facilities = stored
    assert _plan(staffing.staffing_kpis(days, facilities)).count("Hrs") > 0
    scans = [
        line
        for line in _plan(staffing.staffing_kpis(days, facilities)).splitlines()
        if "FileScan" in line and "contractor_hrs" in line
    ]
    assert len(scans) == 1


def test_monthly_totals_shuffle_months_not_facilities(stored):
    days, _ = stored
    plan = _plan(rollups.hours_by_month(days))
    (exchange,) = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert CCN not in exchange and "partial_sum" in plan


def test_hot_facility_is_split_in_a_day_row_semi_join(spark, stored, tmp_path):
    """Without broadcast, the rows of the hot id are spread over several join tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.shuffle.partitions": "16",
    }
    days, facilities = stored
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        plan = _final_plan(of_selected(days, facilities))
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "skew=true" in plan


@pytest.mark.parametrize(
    "size, partitions", [(1, 200), (1 << 40, 8192), (100 << 40, 819_200)]
)
def test_task_counts_follow_the_input(size, partitions):
    assert partitions_for(size, 200) == partitions


def test_task_counts_are_restored(spark, stored):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_tasks(spark, *stored):
        pass
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_input_size_is_known_without_reading(stored):
    days, facilities = stored
    assert input_bytes(days) > input_bytes(facilities) > 0


def test_summaries_are_added_in_parts(spark):
    """Sums merged where both summaries are made would hold the groups of three aggregates in one task."""
    schema = f"`{CCN}` string, provider_name string, state string, WorkDate int, CY_Qtr string, " \
        "Total_Nurse_Hrs double, employee_hrs double, contractor_hrs double"
    days = spark.createDataFrame([_day(i) for i in range(300)], schema)
    first = F.coalesce(F.col("Total_Nurse_Hrs") % 2 == 0, F.lit(False))
    parts = [summary.staffing_summary(days.where(own)) for own in (first, ~first)]
    added = summary.with_rows_added(*parts)
    assert added._jdf.queryExecution().toString().count("REPARTITION_BY_NUM") == 2
    expected = summary.staffing_summary(days)
    assert added.exceptAll(expected).count() == 0 == expected.exceptAll(added).count()
