"""Joins: rows of selected facilities and state names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facilitymetrics.schemas import CCN

# Postal code -> name, 50 states with DC, GU and PR.
STATE_NAMES: dict[str, str] = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DC": "District of Columbia",
    "DE": "Delaware",
    "FL": "Florida",
    "GA": "Georgia",
    "GU": "Guam",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "PR": "Puerto Rico",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
}


def state_dimension(spark: SparkSession) -> DataFrame:
    """The code/name pairs as an inline table, whose size Catalyst knows exactly."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in STATE_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS states(state_code, state_label)")


def with_state_name(df: DataFrame, code: str = "state", name: str = "state_name") -> DataFrame:
    """Add the state's name; a code that is not in the list stands for itself.

    The dimension has a fixed number of rows, so it is small enough to broadcast at any
    size of ``df``.
    """
    states = F.broadcast(state_dimension(df.sparkSession))
    return (
        df.join(states, F.col(code) == F.col("state_code"), "left")
        .withColumn(name, F.coalesce(F.col("state_label"), F.col(code)))
        .drop("state_code", "state_label")
    )


def selected_ids(facilities: DataFrame) -> DataFrame:
    """Distinct facility ids of a selection; a missing id counts as an id."""
    return facilities.select(F.col(CCN).alias("selected_ccn")).distinct()


def of_selected(
    staffing: DataFrame, facilities: DataFrame, missing_ids: bool = True
) -> DataFrame:
    """Rows of ``staffing`` whose facility is selected; a missing id matches a missing id.

    ``staffing`` may be day rows or rows already grouped by facility id.  Callers that
    aggregate should pass the grouped form: Catalyst moves the semi-join below the
    aggregate when the id set is small enough to broadcast (few rows get aggregated), and
    leaves it above otherwise (grouped rows, not day rows, are shuffled for the join, and a
    hot facility is down to its groups).  ``missing_ids=False`` makes it a plain equi-join
    for rows known to have an id.

    The ids are not made distinct, which a semi-join does not need: Spark then builds a Bloom filter of the ids of a narrow
    selection (a missing id has its place in it) and drops the other rows of a large table at its scan, before the shuffle.
    """
    ids = facilities.select(F.col(CCN).alias("selected_ccn"))
    have, wanted = staffing[CCN], ids["selected_ccn"]
    same = have.eqNullSafe(wanted) if missing_ids else have == wanted
    return staffing.join(ids, same, "left_semi")
