"""Small hand-made refined tables holding every edge case, and a row helper."""

from facilitymetrics.schemas import CYCLE_DEFICIENCIES, PBJ, PROVIDER_INFO, REFINED

PBJ_NAMES = (
    "PROVNUM PROVNAME STATE WorkDate CY_Qtr Hrs_RN Hrs_LPN Hrs_CNA "
    "Hrs_RN_emp Hrs_LPN_emp Hrs_CNA_emp Hrs_NAtrn_emp Hrs_MedAide_emp "
    "Hrs_RN_ctr Hrs_LPN_ctr Hrs_CNA_ctr Hrs_NAtrn_ctr Hrs_MedAide_ctr"
).split()

PLAIN = (
    "015009", "ALPHA", "AL", 20241001, "2024Q4", 10.0, 20.0, 70.0,
    8.0, 16.0, 56.0, 0.0, 0.0, 2.0, 4.0, 14.0, 0.0, 0.0,
)
ZEROS = ("015009", "ALPHA", "AL", 20241002, "2024Q4") + (0.0,) * 13
PARTLY_NULL = (
    "015009", "ALPHA", "AL", 20241101, "2024Q4", None, 5.0, 5.0,
    None, 4.0, 4.0, 0.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0,
)
NO_STATE = (
    "025010", "BETA", None, 20241001, "2024Q4", 5.0, 5.0, 10.0,
    4.0, 4.0, 8.0, 1.0, 1.0, 1.0, 1.0, 2.0, 0.0, 0.0,
)


def _in_order(names, rows, dataset):
    """Rows rearranged to the declared column order of a dataset."""
    declared = REFINED[dataset]
    position = {name: i for i, name in enumerate(names)}
    return [tuple(row[position[field.name]] for field in declared.fields) for row in rows]


def refined_pbj(spark, rows=(PLAIN, PLAIN, ZEROS, PARTLY_NULL, NO_STATE)):
    return spark.createDataFrame(_in_order(PBJ_NAMES, rows, PBJ), REFINED[PBJ])


def provider_row(ccn, name, state, owner, beds, residents, overall=None, staffing=None):
    known = {
        "CMS Certification Number (CCN)": ccn,
        "Provider Name": name,
        "State": state,
        "Ownership Type": owner,
        "Number of Certified Beds": beds,
        "Average Number of Residents per Day": residents,
        "Overall Rating": overall,
        "Staffing Rating": staffing,
    }
    return tuple(known.get(field.name) for field in REFINED[PROVIDER_INFO].fields)


PROVIDERS = (
    provider_row("015009", "ALPHA", "AL", "For profit", 100, 50.0, 3, None),
    provider_row("025010", "BETA", "AK", "Non profit", 0, 0.0, 5, 4),
    provider_row("035011", "GAMMA", "AL", "For profit", 40, 30.0, None, 2),
)


def refined_provider(spark, rows=PROVIDERS):
    return spark.createDataFrame(list(rows), REFINED[PROVIDER_INFO])


def refined_quality(spark, scores):
    names = ", ".join(f"`Q{n} Measure Score` double" for n in range(1, 5))
    return spark.createDataFrame(scores, names)


def refined_state_averages(spark, rows):
    names = ", ".join(f"`{name}` double" for name in CYCLE_DEFICIENCIES)
    return spark.createDataFrame(rows, f"`State or Nation` string, {names}")


def as_tuples(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
