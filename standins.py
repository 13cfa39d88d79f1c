"""The four datasets, derived by Spark from the test tables.

The test data has no facility tables, so parts stand in for facilities, line items for
their staffing days and quality measures, and suppliers for state averages.  Every
line item and part is used.  Missing values and zero divisors are put in by rule, since
the tables contain none.  Hours are multiples of 1/16, whose sums are exact in any order, so
both engines must agree to the last bit.

A staffing row carries its own facility name and state, like the table it stands for;
they are computed from the part key, not joined in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from facilitymetrics.operators.joins import STATE_NAMES
from facilitymetrics.operators.reshape import renamed
from facilitymetrics.plans.curate import DERIVE
from facilitymetrics.schemas import (
    PBJ,
    PROVIDER_INFO,
    QUALITY,
    RENAMES,
    STATE_AVERAGES,
)

_CODES = ", ".join(f"'{code}'" for code in STATE_NAMES)
_QUARTER = "concat(year(l_shipdate), 'Q', quarter(l_shipdate))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _state(key: str) -> str:
    """One of the state codes by key; one key in 54 has none."""
    return f"get(array({_CODES}), cast({key} % {len(STATE_NAMES) + 1} as int))"


def _name(key: str) -> str:
    """Three consecutive keys share a name."""
    return f"concat('FACILITY ', {key} div 3)"


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{value} AS `{name}`" for name, value in columns.items()])


def refined_provider_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(
        table(spark, sf_dir, "part"),
        {
            "CMS Certification Number (CCN)": "if(p_size = 13, null, string(p_partkey))",
            "Provider Name": _name("p_partkey"),
            "State": _state("p_partkey"),
            "Ownership Type": "p_type",
            "Provider Type": "p_brand",
            "Provider Address": "p_name",
            "Zip Code": "concat('0', p_size)",
            "Number of Certified Beds": "p_size - 1",
            "Average Number of Residents per Day":
                "if(p_size = 50, 0D, double(floor(p_retailprice)) / 32)",
            "Overall Rating": "nullif(p_size % 6, 0)",
            "Staffing Rating": "nullif(p_size % 7, 6)",
            "QM Rating": "p_size % 5 + 1",
            "Long-Stay QM Rating": "p_size % 4 + 1",
            "Short-Stay QM Rating": "p_size % 3 + 1",
            "Total nursing staff turnover": "double(p_size) / 64",
            "Registered nurse turnover": "if(p_size % 10 = 0, null, double(p_size) / 128)",
            "Number of administrators who have left the nursing home": "p_size % 2",
        },
    )


def refined_pbj(spark: SparkSession, sf_dir: str) -> DataFrame:
    nurse = "(l_quantity - 1) / 4"
    practical = "if(l_linenumber = 3, null, round(l_discount * 100) / 4)"
    aide = "round(l_tax * 100) / 4"
    return _select(
        table(spark, sf_dir, "lineitem"),
        {
            "PROVNUM": "if(l_quantity = 50, null, string(l_partkey))",
            "PROVNAME": f"if(l_linenumber = 7, null, {_name('l_partkey')})",
            "STATE": f"if(l_discount = 0.01D, null, {_state('l_partkey')})",
            # Some days are missing, others are no day of the calendar.
            "WorkDate":
                "case when l_linenumber = 6 then null when l_tax = 0.08D then 20241399 else "
                "year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) end",
            "CY_Qtr": _QUARTER,
            "Hrs_RN": nurse,
            "Hrs_LPN": practical,
            "Hrs_CNA": aide,
            "Hrs_RN_emp": f"{nurse} * 0.75D",
            "Hrs_LPN_emp": practical,
            "Hrs_CNA_emp": f"{aide} * 0.5D",
            "Hrs_NAtrn_emp": "if(l_linestatus = 'F', 1D, 0D)",
            "Hrs_MedAide_emp": "double(l_linenumber) / 2",
            "Hrs_RN_ctr": f"{nurse} * 0.25D",
            "Hrs_LPN_ctr": "if(l_returnflag = 'R', null, 0.5D)",
            "Hrs_CNA_ctr": f"{aide} * 0.5D",
            "Hrs_NAtrn_ctr": "0D",
            "Hrs_MedAide_ctr": "0.25D",
            "l_linestatus": "l_linestatus",
        },
    )


def refined_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(
        table(spark, sf_dir, "lineitem"),
        {
            "CMS Certification Number (CCN)": "string(l_partkey)",
            "Provider Name": _name("l_partkey"),
            "Provider Address": "concat('SUITE ', l_suppkey)",
            "Zip Code": "concat('0', l_suppkey)",
            "Measure Code": "concat('M', l_linenumber)",
            "Measure Description": "concat('Measure ', l_linenumber)",
            "Resident Type": "l_returnflag",
            "Measure Period": _QUARTER,
            "Q1 Measure Score": "nullif(l_discount, 0D)",
            "Q2 Measure Score": "nullif(l_tax, 0D)",
            "Q3 Measure Score": "if(l_returnflag = 'A', l_quantity, null)",
            "Q4 Measure Score": "if(l_linestatus = 'F', double(l_linenumber), null)",
            "Four Quarter Average Score": "l_extendedprice",
            "Processing Date": "date(l_shipdate)",
        },
    )


def raw_state_averages(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """State averages, with further columns of the suppliers if named."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    return _select(
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey),
        {
            "State or Nation": "n_name",
            "Cycle 1 Total Number of Health Deficiencies":
                "if(s_suppkey % 7 = 0, null, s_acctbal)",
            "Cycle 2 Total Number of Health Deficiencies":
                "if(s_suppkey % 3 = 0, null, double(s_nationkey))",
            "Cycle 3 Total Number of Health Deficiencies":
                "if(s_suppkey % 5 = 0, null, s_acctbal / 2)",
            "Processing Date": "date'2024-10-01'",
            **{name: name for name in more},
        },
    )


REFINED_TABLES = {
    PBJ: refined_pbj,
    PROVIDER_INFO: refined_provider_info,
    QUALITY: refined_quality,
    STATE_AVERAGES: raw_state_averages,
}


def refined(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return REFINED_TABLES[dataset](spark, sf_dir)


def curated(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """What a report reads: named and derived columns.  Copies were dropped when the curated
    table was written, so a report does not repeat the dedup."""
    return DERIVE[dataset](renamed(refined(spark, sf_dir, dataset), RENAMES[dataset]))
