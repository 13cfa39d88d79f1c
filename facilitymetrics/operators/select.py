"""Facility selections and the option lists they are chosen from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "All"


@dataclass(frozen=True)
class FacilityFilter:
    """Chosen state, owner and provider; ``None`` or ``"All"`` leaves a column open."""

    state: str | None = None
    owner: str | None = None
    provider: str | None = None

    def full_scope(self, facilities: DataFrame) -> DataFrame:
        """Rows matching every choice."""
        return _matching(
            facilities,
            {
                "state": self.state,
                "ownership_type": self.owner,
                "provider_name": self.provider,
            },
        )

    def chart_scope(self, facilities: DataFrame) -> DataFrame:
        """Rows matching state and owner; the provider choice is ignored."""
        return _matching(facilities, {"state": self.state, "ownership_type": self.owner})


EVERYTHING = FacilityFilter()


def _matching(df: DataFrame, choices: dict[str, str | None]) -> DataFrame:
    for column, choice in choices.items():
        if choice is not None and choice != ALL:
            df = df.filter(F.col(column) == F.lit(choice))
    return df


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column has a value."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, nulls left out, ascending."""
    return present(df.select(column), column).distinct().orderBy(column)


def state_options(facilities: DataFrame) -> DataFrame:
    return distinct_sorted(facilities, "state")


def owner_options(facilities: DataFrame, state: str | None = None) -> DataFrame:
    """Owners of the whole table, or of one state when it is given."""
    return distinct_sorted(FacilityFilter(state=state).full_scope(facilities), "ownership_type")


def provider_options(
    facilities: DataFrame, state: str | None = None, owner: str | None = None
) -> DataFrame:
    return distinct_sorted(FacilityFilter(state, owner).full_scope(facilities), "provider_name")
