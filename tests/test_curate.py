import math

import pytest
from pyspark.sql import functions as F

import facility_rows as rows
from facilitymetrics.functions import rowwise
from facilitymetrics.operators.aggs import deduplicated
from facilitymetrics.operators.reshape import missing_sources, renamed
from facilitymetrics.plans.curate import curate
from facilitymetrics.schemas import (
    CCN,
    CURATED,
    PBJ,
    PROVIDER_INFO,
    QUALITY,
    REFINED,
    RENAMES,
    STATE_AVERAGES,
)
from facilitymetrics.sources.conform import conform


def test_pbj_derived_columns(pbj):
    derived = (
        "Total_Nurse_Hrs", "RN_Percentage", "Total_emp_Nurse_Hrs", "Emp_Nurse_Percentage",
        "employee_hrs", "contractor_hrs",
    )
    found = {
        (row[CCN], row["WorkDate"]): tuple(row[name] for name in derived)
        for row in pbj.collect()
    }
    assert pbj.count() == 4  # the copy is gone
    assert found == {
        ("015009", 20241001): (100.0, 0.1, 80.0, 0.1, 80.0, 20.0),
        ("015009", 20241002): (0.0, None, 0.0, None, 0.0, 0.0),
        ("015009", 20241101): (None, None, None, None, None, 3.0),
        ("025010", 20241001): (20.0, 0.25, 16.0, 0.25, 18.0, 4.0),
    }


def test_provider_occupancy(provider):
    found = dict(rows.as_tuples(provider, "provider_name", "occupancy_rate"))
    assert found == {"ALPHA": 0.5, "BETA": None, "GAMMA": 0.75}


def test_quality_derived_columns(spark):
    scores = [
        (1.0, 2.0, 3.0, 4.0),
        (None, 2.0, None, 5.0),
        (3.0, None, None, None),
        (None, None, None, None),
    ]
    curated = curate(rows.refined_quality(spark, scores), QUALITY)
    found = {
        row[:4]: row[4:]
        for row in rows.as_tuples(
            curated,
            *[f"q{n}_measure_score" for n in range(1, 5)],
            "missing_quarter_count", "sum_of_available_quarterly_scores",
            "max_quarterly_measure_score", "min_quarterly_measure_score",
            "quarterly_score_range",
        )
    }
    assert found == {
        scores[0]: (0, 10.0, 4.0, 1.0, 3.0),
        scores[1]: (2, 7.0, 5.0, 2.0, 3.0),
        scores[2]: (3, 3.0, 3.0, 3.0, 0.0),
        scores[3]: (4, 0.0, None, None, None),
    }


def test_state_averages_derived_columns(spark):
    source = rows.refined_state_averages(
        spark,
        [("AL", 5.0, 7.5, 6.0), ("NATION", None, 4.0, None), ("GU", None, None, None)],
    )
    curated = curate(source, STATE_AVERAGES)
    found = rows.as_tuples(
        curated, "state", "all_cycle_total_health_deficiencies",
        "total_health_deficiencies_range",
    )
    assert sorted(found) == [("AL", 18.5, 2.5), ("GU", 0.0, None), ("NATION", 4.0, 0.0)]


def test_scores_that_arrive_as_text_are_compared_as_numbers(spark):
    source = spark.createDataFrame(
        [("9", "10", "n/a", "NaN")],
        ", ".join(f"`Q{n} Measure Score` string" for n in range(1, 5)),
    )
    row = curate(source, QUALITY).first()
    assert row["max_quarterly_measure_score"] == 10.0
    assert row["min_quarterly_measure_score"] == 9.0
    assert row["missing_quarter_count"] == 2
    assert row["sum_of_available_quarterly_scores"] == 19.0


def test_nan_is_missing(spark):
    source = rows.refined_state_averages(spark, [("AL", math.nan, 2.0, 5.0)])
    row = curate(source, STATE_AVERAGES).first()
    assert row["all_cycle_total_health_deficiencies"] == 7.0
    assert row["total_health_deficiencies_range"] == 3.0


def test_numeric_identifiers_become_text(spark):
    source = spark.createDataFrame([(15009, "A")], "PROVNUM int, PROVNAME string")
    typed = renamed(conform(source, REFINED[PBJ]), RENAMES[PBJ])
    assert rows.as_tuples(typed) == [("15009", "A")]


def test_extra_columns_pass_through(spark, refined_provider):
    curated = curate(refined_provider.selectExpr("*", "'x' AS note"), PROVIDER_INFO)
    assert {row["note"] for row in curated.collect()} == {"x"}


def test_curated_columns_are_the_declared_ones(pbj, provider):
    assert set(pbj.columns) == set(CURATED[PBJ].names)
    assert set(provider.columns) == set(CURATED[PROVIDER_INFO].names)


def test_rename_skips_what_is_not_there_unless_strict(spark):
    source = spark.createDataFrame([("1", "x")], "PROVNUM string, other string")
    once = renamed(source, RENAMES[PBJ])
    assert once.columns == [CCN, "other"]
    assert renamed(once, RENAMES[PBJ]).columns == once.columns
    assert missing_sources(source, RENAMES[PBJ]) == ["PROVNAME", "STATE"]
    with pytest.raises(ValueError, match="PROVNAME"):
        renamed(source, RENAMES[PBJ], strict=True)


def test_dedup_is_idempotent_and_treats_null_as_equal(spark):
    source = spark.createDataFrame(
        [(None, 1.0), (None, 1.0), ("a", None), ("a", None), ("a", 0.0)], "k string, v double"
    )
    once = deduplicated(source)
    assert once.count() == 3
    assert deduplicated(once).count() == 3


def test_ratio_of_zero_divisor_is_null_in_ansi_mode(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    source = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 4.0)], "a double, b double")
    found = rows.as_tuples(source.select(rowwise.safe_ratio("a", "b")))
    assert found == [(None,), (None,), (0.25,)]


def test_infinite_becomes_null(spark):
    source = spark.createDataFrame([(math.inf,), (-math.inf,), (2.0,), (None,)], "v double")
    found = rows.as_tuples(source.select(rowwise.finite_or_null(F.col("v"))))
    assert found == [(None,), (None,), (2.0,), (None,)]


def test_shares(spark):
    source = spark.createDataFrame(
        [(0.0, 0.0), (80.0, 20.0), (10.0, 0.0)], "emp double, ctr double"
    )
    emp, ctr = F.col("emp"), F.col("ctr")
    found = rows.as_tuples(
        source.select(
            rowwise.share_or_null(ctr, emp),
            rowwise.share_or_zero(emp, emp + ctr),
            rowwise.ratio_if_positive(emp, ctr),
        )
    )
    assert found == [(None, 0.0, None), (0.2, 0.8, 4.0), (0.0, 1.0, None)]
