"""Datasets of the lake: declared columns, rename maps and derived columns.

Only the columns the package works with are declared.  Every other column of an
input table passes through the jobs untouched.
"""

from __future__ import annotations

from pyspark.sql import types as T

PBJ = "pbj"
PROVIDER_INFO = "provider_info"
QUALITY = "quality"
STATE_AVERAGES = "state_averages"
DATASETS = (PBJ, PROVIDER_INFO, QUALITY, STATE_AVERAGES)

CCN = "cms_certification_number_ccn"
CCN_LABEL = "CMS Certification Number (CCN)"

# Refined (source) column name -> curated column name.
RENAMES: dict[str, dict[str, str]] = {
    PBJ: {
        "PROVNUM": CCN,
        "PROVNAME": "provider_name",
        "STATE": "state",
    },
    PROVIDER_INFO: {
        CCN_LABEL: CCN,
        "Provider Name": "provider_name",
        "State": "state",
        "Ownership Type": "ownership_type",
        "Provider Type": "provider_type",
        "Number of Certified Beds": "certified_beds",
        "Average Number of Residents per Day": "average_residents_per_day",
        "Provider Address": "provider_address",
        "Zip Code": "zip_code",
        "Long-Stay QM Rating": "long_stay_qm_rating",
        "Short-Stay QM Rating": "short_stay_qm_rating",
        "QM Rating": "qm_rating",
        "Overall Rating": "overall_rating",
        "Staffing Rating": "staffing_rating",
        "Total nursing staff turnover": "total_nursing_staff_turnover",
        "Registered nurse turnover": "registered_nurse_turnover",
        "Number of administrators who have left the nursing home":
            "number_of_administrators_who_left_the_nursing_home",
    },
    QUALITY: {
        "Q1 Measure Score": "q1_measure_score",
        "Q2 Measure Score": "q2_measure_score",
        "Q3 Measure Score": "q3_measure_score",
        "Q4 Measure Score": "q4_measure_score",
        CCN_LABEL: CCN,
        "Provider Name": "provider_name",
        "Measure Code": "measure_code",
        "Measure Description": "measure_description",
        "Provider Address": "provider_address",
        "Zip Code": "zip_code",
        "Resident Type": "resident_type",
        "Four Quarter Average Score": "four_quarter_average_score",
        "Measure Period": "measure_period",
        "Processing Date": "processing_date",
    },
    STATE_AVERAGES: {
        "State or Nation": "state",
        "Processing Date": "processing_date",
    },
}

NURSE_HOURS = ("Hrs_RN", "Hrs_LPN", "Hrs_CNA")
EMPLOYEE_NURSE_HOURS = tuple(f"{name}_emp" for name in NURSE_HOURS)
EMPLOYEE_HOURS = EMPLOYEE_NURSE_HOURS + ("Hrs_NAtrn_emp", "Hrs_MedAide_emp")
CONTRACTOR_HOURS = tuple(name.replace("_emp", "_ctr") for name in EMPLOYEE_HOURS)
QUARTER_SCORES = tuple(f"q{n}_measure_score" for n in range(1, 5))
CYCLE_DEFICIENCIES = tuple(
    f"Cycle {n} Total Number of Health Deficiencies" for n in range(1, 4)
)


def _struct(**columns_by_type: tuple[str, ...] | list[str]) -> T.StructType:
    types = {
        "text": T.StringType(),
        "whole": T.IntegerType(),
        "number": T.DoubleType(),
        "day": T.DateType(),
    }
    return T.StructType(
        [
            T.StructField(name, types[kind], True)
            for kind, names in columns_by_type.items()
            for name in names
        ]
    )


REFINED: dict[str, T.StructType] = {
    PBJ: _struct(
        text=["PROVNUM", "PROVNAME", "STATE", "CY_Qtr"],
        whole=["WorkDate"],
        number=NURSE_HOURS + EMPLOYEE_HOURS + CONTRACTOR_HOURS,
    ),
    PROVIDER_INFO: _struct(
        text=[
            CCN_LABEL, "Provider Name", "State", "Ownership Type", "Provider Type",
            "Provider Address", "Zip Code",
        ],
        whole=[
            "Number of Certified Beds", "Long-Stay QM Rating", "Short-Stay QM Rating",
            "QM Rating", "Overall Rating", "Staffing Rating",
            "Number of administrators who have left the nursing home",
        ],
        number=[
            "Average Number of Residents per Day", "Total nursing staff turnover",
            "Registered nurse turnover",
        ],
    ),
    QUALITY: _struct(
        text=[
            CCN_LABEL, "Provider Name", "Provider Address", "Zip Code", "Measure Code",
            "Measure Description", "Resident Type", "Measure Period",
        ],
        number=[
            "Q1 Measure Score", "Q2 Measure Score", "Q3 Measure Score",
            "Q4 Measure Score", "Four Quarter Average Score",
        ],
        day=["Processing Date"],
    ),
    STATE_AVERAGES: _struct(
        text=["State or Nation"],
        number=CYCLE_DEFICIENCIES,
        day=["Processing Date"],
    ),
}

_DERIVED: dict[str, T.StructType] = {
    PBJ: _struct(
        number=[
            "Total_Nurse_Hrs", "RN_Percentage", "Total_emp_Nurse_Hrs",
            "Emp_Nurse_Percentage", "employee_hrs", "contractor_hrs",
        ]
    ),
    PROVIDER_INFO: _struct(number=["occupancy_rate"]),
    QUALITY: _struct(
        whole=["missing_quarter_count"],
        number=[
            "sum_of_available_quarterly_scores", "max_quarterly_measure_score",
            "min_quarterly_measure_score", "quarterly_score_range",
        ],
    ),
    STATE_AVERAGES: _struct(
        number=["all_cycle_total_health_deficiencies", "total_health_deficiencies_range"]
    ),
}


def curated_schema(dataset: str) -> T.StructType:
    """Declared columns of a curated table: the refined ones renamed, plus the derived ones."""
    names = RENAMES[dataset]
    renamed = [
        T.StructField(names.get(field.name, field.name), field.dataType, True)
        for field in REFINED[dataset].fields
    ]
    return T.StructType(renamed + _DERIVED[dataset].fields)


CURATED: dict[str, T.StructType] = {dataset: curated_schema(dataset) for dataset in DATASETS}

# Work dates arrive as whole numbers, text or dates; they are parsed where they are
# used, so no boundary may force them into one type.
DATE_LIKE = frozenset({"workdate"})
