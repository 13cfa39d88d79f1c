"""Report tables over the hand-made rows, with no choice, a choice and an empty choice."""

import pytest

import facility_rows as rows
from pyspark.sql import functions as F

from facilitymetrics.operators.joins import STATE_NAMES, of_selected, with_state_name
from facilitymetrics.operators.select import (
    FacilityFilter,
    owner_options,
    provider_options,
    state_options,
)
from facilitymetrics.plans import occupancy, rollups, staffing
from facilitymetrics.plans.curate import curate
from facilitymetrics.plans.facility_staffing import facility_staffing
from facilitymetrics.plans.summary import FACILITY, FACILITY_STATE, Summary, staffing_summary
from facilitymetrics.schemas import CCN

EMPTY = FacilityFilter(state="ZZ")
ALABAMA = FacilityFilter(state="AL")


def test_options(provider):
    def values(df):
        return [row[0] for row in df.collect()]

    assert values(state_options(provider)) == ["AK", "AL"]
    assert values(owner_options(provider)) == ["For profit", "Non profit"]
    assert values(owner_options(provider, "AK")) == ["Non profit"]
    assert values(owner_options(provider, "All")) == ["For profit", "Non profit"]
    assert values(provider_options(provider, "AL", "For profit")) == ["ALPHA", "GAMMA"]
    assert values(provider_options(provider)) == ["ALPHA", "BETA", "GAMMA"]


def test_scopes(provider):
    choice = FacilityFilter(state="AL", owner="For profit", provider="GAMMA")
    assert choice.full_scope(provider).count() == 1
    assert choice.chart_scope(provider).count() == 2
    assert FacilityFilter("All", "All", "All").full_scope(provider).count() == 3


def test_occupancy_kpis(provider):
    kpis = occupancy.occupancy_kpis(provider)
    (found,) = rows.as_tuples(kpis)
    assert found == (3, 0.625, pytest.approx(140 / 3), pytest.approx(80 / 3))
    assert rows.as_tuples(occupancy.occupancy_kpi_text(kpis)) == [
        ("3", "62.5%", "46.7", "26.7")
    ]
    assert rows.as_tuples(occupancy.occupancy_kpis(provider, EMPTY)) == [(0, 0.0, 0.0, 0.0)]
    # Rows without any value give a missing mean here, unlike an empty selection.
    in_alaska = occupancy.occupancy_kpis(provider, FacilityFilter(state="AK"))
    assert rows.as_tuples(in_alaska) == [(1, None, 0.0, 0.0)]


def test_occupancy_provider_detail(provider):
    assert rows.as_tuples(occupancy.provider_detail(provider)) == [
        ("ALPHA", "Alabama", "For profit", "50.00%", "★★★☆☆ (3/5)", "Not rated")
    ]
    assert occupancy.provider_detail(provider, EMPTY).count() == 0


def test_occupancy_charts(provider):
    assert rows.as_tuples(occupancy.occupancy_by_provider(provider)) == [
        ("GAMMA", 0.75), ("ALPHA", 0.5), ("BETA", None),
    ]
    assert rows.as_tuples(occupancy.beds_by_provider(provider)) == [
        ("ALPHA", 100.0), ("GAMMA", 40.0), ("BETA", 0.0),
    ]
    assert rows.as_tuples(occupancy.providers_by_state(provider)) == [("AL", 2), ("AK", 1)]
    assert rows.as_tuples(occupancy.occupancy_ranking(provider)) == [
        ("GAMMA", "AL", 0.75), ("ALPHA", "AL", 0.5), ("BETA", "AK", None),
    ]
    one = FacilityFilter(state="AL", provider="ALPHA")
    assert occupancy.occupancy_by_provider(provider, one).count() == 2
    assert occupancy.occupancy_ranking(provider, one).count() == 1


def test_facility_staffing(pbj, provider):
    by_state = facility_staffing(pbj, provider, FACILITY_STATE)
    assert rows.as_tuples(by_state) == [("015009", "ALPHA", "AL", 50.0)]
    by_name = facility_staffing(pbj, provider, FACILITY)
    assert sorted(rows.as_tuples(by_name)) == [
        ("015009", "ALPHA", 50.0), ("025010", "BETA", 20.0),
    ]


def test_facility_analyses(pbj, provider):
    assert rows.as_tuples(
        occupancy.facility_analysis(pbj, provider),
        "provider_name", "state_x", "state_y", "nurse_hours_per_resident",
    ) == [("ALPHA", "AL", "AL", 1.0)]
    found = rows.as_tuples(
        staffing.facility_analysis(pbj, provider),
        "provider_name", "state", "nurse_hours_per_resident",
    )
    assert sorted(found) == [("ALPHA", "AL", 1.0), ("BETA", "AK", None)]


def test_staffing_kpis(pbj, provider):
    kpis = staffing.staffing_kpis(pbj, provider)
    (row,) = kpis.collect()
    assert row.asDict() == {
        "providers": 3,
        "avg_nurse_hours": 35.0,
        "avg_nurse_hours_per_resident": 1.0,
        "avg_occupancy": 0.5,
        "total_employee_hrs": 98.0,
        "total_contractor_hrs": 27.0,
        "total_nursing_hrs": 125.0,
        "contractor_hours_pct": 0.216,
        "employee_contractor_ratio": pytest.approx(98 / 27),
        "employee_pct": 0.784,
        "contractor_pct": 0.216,
    }
    assert rows.as_tuples(staffing.staffing_kpi_text(kpis)) == [
        ("3", "35.0", "1.00", "50.0%", "98", "27", "3.63:1", "21.6%")
    ]


def test_staffing_kpis_of_nothing(pbj, provider):
    kpis = staffing.staffing_kpis(pbj, provider, EMPTY)
    assert rows.as_tuples(kpis) == [
        (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, None, 0.0, 0.0)
    ]
    assert rows.as_tuples(staffing.staffing_kpi_text(kpis)) == [
        ("0", "0.0", "0.00", "0.0%", "0", "0", "N/A", "N/A")
    ]
    assert rows.as_tuples(staffing.staffing_mix(pbj, provider, EMPTY)) == [
        ("Employee", 0.0, 0.0), ("Contractor", 0.0, 0.0),
    ]


def test_staffing_mix(pbj, provider):
    assert rows.as_tuples(staffing.staffing_mix(pbj, provider)) == [
        ("Employee", 98.0, 0.784), ("Contractor", 27.0, 0.216),
    ]


def test_staffing_provider_detail(pbj, provider):
    assert rows.as_tuples(staffing.provider_detail(pbj, provider)) == [
        ("ALPHA", "Alabama", "For profit", "35.0", "1.00", "50.0%")
    ]
    assert rows.as_tuples(
        staffing.provider_detail(pbj, provider, FacilityFilter(state="AK"))
    ) == [("BETA", "Alaska", "Non profit", "20.0", "0.00", "0.0%")]
    assert staffing.provider_detail(pbj, provider, EMPTY).count() == 0


def test_hours_per_resident_by_state(pbj, provider):
    analysis = staffing.facility_analysis(pbj, provider)
    assert rows.as_tuples(staffing.hours_per_resident_by_state(analysis)) == [
        ("AL", 1.0), ("AK", None),
    ]


def test_rollups(pbj):
    assert sorted(rows.as_tuples(rollups.monthly_hours(pbj))) == [
        ("015009", "ALPHA", "AL", "2024-10", 100.0),
        ("015009", "ALPHA", "AL", "2024-11", 0.0),
    ]
    assert rows.as_tuples(rollups.hours_by_month(pbj)) == [("2024-10", 100.0), ("2024-11", 0.0)]
    assert rows.as_tuples(rollups.hours_by_state(pbj)) == [("AL", 100.0)]
    assert rows.as_tuples(rollups.hours_by_provider(pbj)) == [("ALPHA", "AL", 100.0)]
    assert sorted(rows.as_tuples(rollups.record_completeness(pbj))) == [
        ("015009", "2024Q4", 3), ("025010", "2024Q4", 1),
    ]


def test_reports_agree_from_days_and_from_the_summary(pbj, provider):
    summary = Summary(staffing_summary(pbj))
    for report in (
        rollups.monthly_hours, rollups.hours_by_month, rollups.hours_by_state,
        rollups.hours_by_provider, rollups.record_completeness,
        lambda rows_of: facility_staffing(rows_of, provider, FACILITY),
        lambda rows_of: facility_staffing(rows_of, provider, FACILITY_STATE),
        lambda rows_of: occupancy.facility_analysis(rows_of, provider),
        lambda rows_of: staffing.facility_analysis(rows_of, provider),
        lambda rows_of: staffing.staffing_kpis(rows_of, provider),
        lambda rows_of: staffing.staffing_mix(rows_of, provider),
        lambda rows_of: staffing.provider_detail(rows_of, provider),
    ):
        assert report(summary).columns == report(pbj).columns
        found = rows.as_tuples(report(summary))
        assert sorted(found, key=str) == sorted(rows.as_tuples(report(pbj)), key=str)


def test_day_rows_may_have_columns_named_like_measures(pbj):
    more = pbj.withColumns({c: F.lit(91) for c in ("record_count", "hour_days", "month")})
    for report in (rollups.record_completeness, rollups.hours_by_month):
        assert sorted(rows.as_tuples(report(more))) == sorted(rows.as_tuples(report(pbj)))


def test_detail_of_a_facility_stored_without_state_and_with_it(pbj, provider):
    stateless = provider.withColumn("state", F.lit(None).cast("string"))
    both = provider.union(stateless)
    first = staffing.provider_detail(pbj, both).first()
    assert first["state_name"] == staffing.provider_detail(pbj, provider).first()["state_name"]
    assert first["state_name"] is not None


def test_rows_without_a_work_day_are_left_out_of_months(spark):
    undated = rows.PLAIN[:3] + (None,) + rows.PLAIN[4:]
    source = rows.refined_pbj(spark, [rows.PLAIN, undated])
    curated = curate(source, "pbj")
    assert rows.as_tuples(rollups.hours_by_month(curated)) == [("2024-10", 100.0)]
    assert rows.as_tuples(rollups.hours_by_state(curated)) == [("AL", 100.0)]


def test_missing_id_matches_missing_id(spark):
    days = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], f"{CCN} string, n int")
    chosen = spark.createDataFrame([(None,), ("a",), ("a",)], f"{CCN} string")
    assert sorted(row["n"] for row in of_selected(days, chosen).collect()) == [1, 2]
    assert [row["n"] for row in of_selected(days, chosen, missing_ids=False).collect()] == [2]


def test_means_over_joined_rows_count_repeated_facility_rows(spark, pbj):
    twice = (
        rows.provider_row("015009", "ALPHA", "AL", "For profit", 100, 50.0),
        rows.provider_row("015009", "ALPHA", "GA", "For profit", 50, 40.0),
        rows.provider_row("025010", "BETA", "AK", "Non profit", 10, 10.0),
        rows.provider_row("025010", "RENAMED", "AK", "Non profit", 10, 5.0),
    )
    facilities = curate(rows.refined_provider(spark, twice), "provider_info")
    joined = staffing.facility_analysis(pbj, facilities)
    expected = joined.selectExpr(
        "avg(avg_total_nurse_hrs)", "avg(nurse_hours_per_resident)", "avg(occupancy_rate)"
    ).first()
    kpis = staffing.staffing_kpis(pbj, facilities).first()
    assert joined.count() == 3
    assert tuple(kpis)[1:4] == pytest.approx(tuple(expected))
    assert (kpis["total_employee_hrs"], kpis["total_contractor_hrs"]) == (98.0, 27.0)


def test_unknown_state_stands_for_itself(spark):
    source = spark.createDataFrame([("PR",), ("XX",), (None,)], "state string")
    assert dict(rows.as_tuples(with_state_name(source))) == {
        "PR": "Puerto Rico", "XX": "XX", None: None,
    }
    assert len(STATE_NAMES) == 53
