"""Intermediate tables that survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from facilitymetrics.sources.lake import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` written in buckets of ``key``, so that joins by it need not deal its rows again."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    table = f"scratch_{path.rsplit('/', 1)[1].replace('-', '_')}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt as the buckets are, so each is one file.
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
