"""Mean daily nurse hours per selected facility, shared by both report groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from facilitymetrics.operators.joins import of_selected
from facilitymetrics.operators.select import present
from facilitymetrics.plans.summary import FACILITY, Summary, additive_rows, mean_daily_hours


def facility_staffing(
    pbj: DataFrame | Summary, facilities: DataFrame, keys: Sequence[str] = FACILITY
) -> DataFrame:
    """Mean of the daily totals by facility for the given selection of facilities.

    Rows are grouped first and matched afterwards; see ``of_selected``.
    """
    means = (
        present(additive_rows(pbj), *keys)
        .groupBy(*keys)
        .agg(mean_daily_hours().alias("avg_total_nurse_hrs"))
    )
    return of_selected(means, facilities, missing_ids=False)
