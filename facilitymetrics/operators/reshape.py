"""Renames and wide-to-long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facilitymetrics.functions.rowwise import share_or_zero


def missing_sources(df: DataFrame, names: dict[str, str]) -> list[str]:
    """Columns to rename that exist neither under the old nor under the new name."""
    have = {column.lower() for column in df.columns}
    return [old for old, new in names.items() if not {old.lower(), new.lower()} & have]


def renamed(df: DataFrame, names: dict[str, str], strict: bool = False) -> DataFrame:
    """Rename by map and pass the other columns through.

    A column that is not there is skipped; with ``strict`` it is an error.
    """
    if strict and (missing := missing_sources(df, names)):
        raise ValueError(f"columns to rename are missing: {missing}")
    return df.withColumnsRenamed(names)


def labelled_hours(totals: DataFrame) -> DataFrame:
    """The employee and contractor totals of one row as two labelled rows with shares."""
    whole = F.col("total_employee_hrs") + F.col("total_contractor_hrs")
    kinds = [("Employee", "total_employee_hrs"), ("Contractor", "total_contractor_hrs")]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("Staff Type"),
                        F.col(total).alias("Hours"),
                        share_or_zero(F.col(total), whole).alias("share"),
                    )
                    for label, total in kinds
                ]
            )
        )
    )
