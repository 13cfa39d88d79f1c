"""Spark session used by the command line jobs and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast sides from measured sizes, merges small shuffle
# partitions and splits skewed join partitions.  UTC keeps date buckets independent of
# the cluster's zone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Plans are built faster without a Python call site recorded for every expression.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(
    app_name: str = "facilitymetrics",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
