import datetime

import pytest
from pyspark.sql import functions as F

import facility_rows as rows
from facilitymetrics.functions import textfmt
from facilitymetrics.functions.timeops import month_label, month_start, parse_workday


@pytest.mark.parametrize(
    ("kind", "value", "day"),
    [
        ("int", 20241001, datetime.date(2024, 10, 1)),
        ("bigint", 20240229, datetime.date(2024, 2, 29)),
        ("int", 20230229, None),
        ("int", 20241301, None),
        ("int", 2024100, None),
        ("int", 202411011, None),
        ("int", -20241001, None),
        ("int", 20241000, None),
        ("int", None, None),
        ("string", "20241001", datetime.date(2024, 10, 1)),
        ("string", "2024-10-01", datetime.date(2024, 10, 1)),
        ("string", "2024-10-01 00:00:00", datetime.date(2024, 10, 1)),
        ("string", "not a day", None),
        ("string", "202410011", None),
        ("date", datetime.date(2024, 10, 1), datetime.date(2024, 10, 1)),
        ("timestamp_ntz", datetime.datetime(2024, 10, 1, 23, 0), datetime.date(2024, 10, 1)),
    ],
)
def test_work_days(spark, kind, value, day):
    source = spark.createDataFrame([(value,)], f"workdate {kind}")
    assert source.select(parse_workday(source)).first()[0] == day


def test_month_buckets(spark):
    source = spark.createDataFrame([(datetime.date(2024, 2, 29),)], "day date")
    found = source.select(month_start(F.col("day")), month_label(F.col("day"))).first()
    assert tuple(found) == (datetime.date(2024, 2, 1), "2024-02")


NUMBERS = [0.0, 0.125, 0.135, 0.5, 1.0, 2.5, 1234.5, 1234567.891, 46.6666666, 0.0005, 99.95]


def test_numbers_as_text_match_python_formatting(spark):
    source = spark.createDataFrame([(x,) for x in NUMBERS], "x double")
    x = F.col("x")
    found = rows.as_tuples(
        source.select(
            "x",
            textfmt.fixed(x, 1), textfmt.fixed(x, 2),
            textfmt.grouped(x, 0), textfmt.grouped(x, 1), textfmt.grouped(x, 2),
            textfmt.percent(x, 1), textfmt.percent(x, 2), textfmt.ratio_to_one(x),
        )
    )
    for value, *texts in found:
        assert texts == [
            f"{value:.1f}", f"{value:.2f}", f"{value:,.0f}", f"{value:,.1f}",
            f"{value:,.2f}", f"{value:.1%}", f"{value:.2%}", f"{value:.2f}:1",
        ]


def test_missing_number_as_text(spark):
    source = spark.createDataFrame([(None,)], "x double")
    text = textfmt.or_not_available(textfmt.percent(F.col("x")))
    assert source.select(text).first()[0] == "N/A"


def test_stars(spark):
    source = spark.createDataFrame([(3.0,), (5.0,), (1.0,), (None,)], "r double")
    found = [row[0] for row in source.select(textfmt.stars(F.col("r"))).collect()]
    assert found == ["★★★☆☆ (3/5)", "★★★★★ (5/5)", "★☆☆☆☆ (1/5)", "Not rated"]


def test_work_dates_in_further_forms(spark):
    texts = ["20241001", " 20241001", "20241001 ", "10/01/2024", "2024-10-01", "1/2/2024", "2024100", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "WorkDate string")
    days = [str(r[0]) for r in rows.select(parse_workday(rows)).collect()]
    assert days == ["2024-10-01"] * 5 + ["2024-01-02", "None", "None", "None"]
    for kind in ("double", "float", "decimal(10,0)", "long"):
        rows = spark.createDataFrame([("20241001",), ("20241032",), (None,)], "t string")
        rows = rows.select(rows.t.cast("double").cast(kind).alias("WorkDate"))
        found = [str(r[0]) for r in rows.select(parse_workday(rows)).collect()]
        assert found == (["2024-10-01", "None", "None"] if kind != "float" else found)
    rows = spark.createDataFrame([(20241001.5,), (float("nan"),), (1e300,)], "WorkDate double")
    assert rows.where(parse_workday(rows).isNotNull()).count() == 0
