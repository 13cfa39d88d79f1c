"""Which input files a curated table was made from, to read only what changed since.

A manifest lists path, length and modification time of the files of a refined table.  It is a table of versions beside the
curated data (``_manifest/<dataset>``), written after the data: a job that fails in between finds the same files
changed again, and replacing partitions twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_FILE = ("path", "length", "modified")


@dataclass(frozen=True)
class Changes:
    """Partition values to compute again and to drop; ``everything`` when files say nothing about values."""

    files: DataFrame
    version: int
    everything: bool
    touched: tuple[tuple[str | None, ...], ...] = ()
    gone: tuple[tuple[str | None, ...], ...] = ()


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and modification time of the Parquet files of a table; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return listed.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its form."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def drop_partition(spark: SparkSession, table: str, columns: Sequence[str], values: Sequence[str | None]) -> None:
    """Delete the directory of a partition as Spark names it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    parts = [f"{escape(c)}={NO_VALUE if v is None else escape(v)}" for c, v in zip(columns, values)]
    files, where = file_system(spark, "/".join([table.rstrip("/"), *parts]))
    files.delete(where, True)


def partition_values(paths: DataFrame, columns: Sequence[str]) -> list[tuple[str | None, ...]] | None:
    """Values that the directories of ``paths`` name; None if some path does not name them all.

    There is one for each directory of the table.
    """
    names = [F.regexp_extract("path", rf"/\Q{c}\E=([^/]*)/", 1).alias(f"value_{k}") for k, c in enumerate(columns)]
    found = [tuple(row) for row in paths.select(*names).distinct().collect()]
    if any("" in values for values in found):
        return None
    return sorted((tuple(None if v == NO_VALUE else unquote(v) for v in values) for values in found), key=str)


def in_partitions(df: DataFrame, columns: Sequence[str], values: Sequence[tuple[str | None, ...]]) -> Column:
    """Predicate over partition columns alone, which prunes the scan."""
    kinds = {name: df.select(name).schema[0].dataType for name in columns}
    found = F.lit(False)
    for one in values:
        here = F.lit(True)
        for name, value in zip(columns, one):
            column = F.col(name)
            here = here & (column.isNull() if value is None else column == F.lit(value).cast(kinds[name]))
        found = found | here
    return found


def changes(
    spark: SparkSession, table: str, manifest: str, columns: Sequence[str], changed_only: bool = True
) -> Changes:
    """What to compute again after the files of ``table`` changed since the last manifest.

    Everything without ``changed_only``, without a manifest, or when a file is in no directory by ``columns``.
    """
    # Kept as listed now: a file that comes later is read at the next run.
    pending = f"{manifest.rstrip('/')}_pending"
    input_files(spark, table).write.mode("overwrite").parquet(pending)
    files = spark.read.parquet(pending)
    if not exists(spark, manifest):
        return Changes(files, 0, True)
    versions = spark.read.parquet(manifest)
    latest = versions.agg(F.max("version")).first()[0]
    if not changed_only:
        return Changes(files, latest + 1, True)
    before = versions.where(F.col("version") == latest).select(*_FILE)
    now, old = partition_values(files, columns), partition_values(before, columns)
    other = files.exceptAll(before).select("path").union(before.exceptAll(files).select("path"))
    touched = partition_values(other, columns)
    if now is None or old is None or touched is None:
        return Changes(files, latest + 1, True)
    here = set(now)
    return Changes(
        files, latest + 1, False, tuple(v for v in touched if v in here), tuple(v for v in old if v not in here)
    )


def record(found: Changes, manifest: str) -> None:
    """Append the listed files as the manifest's next version."""
    found.files.withColumn("version", F.lit(found.version)).write.mode("append").parquet(manifest)
