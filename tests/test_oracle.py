"""Every registered query against its SQL counterpart, and invariants of the results."""

import pytest

import __spark_entry__ as entry
from oracle_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.facility_queries()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF_DIR), db, SQL[name]) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def _total(df):
    return df.agg({"Total_Nurse_Hrs": "sum"}).first()[0]


def test_rollup_totals_agree(spark):
    totals = {
        _total(QUERIES[name](spark, SF_DIR))
        for name in ("monthly_hours", "hours_by_month", "hours_by_state", "hours_by_provider")
    }
    assert len(totals) == 1


def test_score_bounds(spark):
    scores = QUERIES["quarterly_scores"](spark, SF_DIR)
    assert scores.filter("missing_quarter_count NOT BETWEEN 0 AND 4").count() == 0
    assert scores.filter("quarterly_score_range < 0").count() == 0
    assert scores.filter("min_quarterly_measure_score > max_quarterly_measure_score").count() == 0


def test_shares_add_up(spark):
    row = QUERIES["staffing_kpis"](spark, SF_DIR).first()
    assert row["employee_pct"] + row["contractor_pct"] == pytest.approx(1.0)
    empty = QUERIES["staffing_kpis_empty"](spark, SF_DIR).first()
    assert empty["employee_pct"] + empty["contractor_pct"] == 0.0


def test_sorted_results_are_sorted(spark):
    hours = [r["Total_Nurse_Hrs"] for r in QUERIES["hours_by_state"](spark, SF_DIR).collect()]
    assert hours == sorted(hours)
    ranks = [
        r["occupancy_rate"] for r in QUERIES["occupancy_ranking"](spark, SF_DIR).collect()
    ]
    present = [rank for rank in ranks if rank is not None]
    assert present == sorted(present, reverse=True)
    assert ranks[: len(present)] == present  # missing values come last
