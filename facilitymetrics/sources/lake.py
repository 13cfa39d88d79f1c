"""Readers and writers for the raw, refined and curated layers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facilitymetrics.schemas import CURATED
from facilitymetrics.sources.conform import conform


# Partition values that a task writes side by side.  As rows come together by value, nearly all tasks have fewer, and
# need no sort of whole rows before the write; Spark sorts what comes beyond.
OPEN_FILES = 8
_OPEN_KEY = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Lake:
    """Root directory of each layer; a dataset is one directory below a root."""

    refined: str
    curated: str

    def refined_path(self, dataset: str) -> str:
        return _join(self.refined, dataset)

    def curated_path(self, dataset: str) -> str:
        return _join(self.curated, dataset)

    def manifest_path(self, dataset: str) -> str:
        """Input files the curated table was made from; Spark's readers skip names that begin with _."""
        return _join(self.curated, f"_manifest/{dataset}")

    def quarantine_path(self, dataset: str) -> str:
        return _join(self.refined, f"_quarantine/{dataset}")

    def audit_path(self, dataset: str) -> str:
        return _join(self.curated, f"_audit/{dataset}")


def _join(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_csv(
    spark: SparkSession,
    path: str,
    declared: T.StructType | None = None,
    infer_rest: bool = True,
) -> DataFrame:
    """CSV with a header row.

    Declared columns get their declared type.  Types of the remaining columns are inferred
    (one extra pass, only when there are such columns) or, without ``infer_rest``, left as
    text.
    """
    reader = spark.read.option("header", True)
    header = reader.csv(path).columns
    known = {} if declared is None else {f.name.lower(): f.dataType for f in declared.fields}
    rest = [name for name in header if name.lower() not in known]
    inferred: dict[str, T.DataType] = {}
    if rest and infer_rest:
        guessed = spark.read.option("header", True).option("inferSchema", True).csv(path)
        inferred = {field.name: field.dataType for field in guessed.schema.fields}
    schema = T.StructType(
        [
            T.StructField(
                name, known.get(name.lower(), inferred.get(name, T.StringType())), True
            )
            for name in header
        ]
    )
    # Files whose header has other names or another order fail instead of being misread.
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_refined(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    return read_parquet(spark, lake.refined_path(dataset))


def read_curated(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """A curated table for reports; filters and column choices still reach the scan."""
    return conform(read_parquet(spark, lake.curated_path(dataset)), CURATED[dataset])


@contextmanager
def _files_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep some files open instead of sorting; a number set by the session stays."""
    configured = int(spark.conf.get(_OPEN_KEY))
    spark.conf.set(_OPEN_KEY, str(configured or OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_KEY, str(configured))


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    touched_partitions_only: bool = False,
    clustered: bool = False,
) -> int:
    """Overwrite ``path`` and return the number of rows written.

    The count is collected by the write itself, so the plan runs once.  With
    ``partition_by`` rows are first brought together by partition value in evenly sized
    pieces (a large value is split, small ones share a task), which bounds the number of
    files; ``clustered`` says that they are so already.  ``touched_partitions_only`` replaces the partitions present
    in ``df`` and keeps the others.
    """
    counted = Observation()
    out = df
    if partition_by and not clustered:
        out = out.hint("rebalance", *[f"`{name}`" for name in partition_by])
    writer = out.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if touched_partitions_only else "static"
        )
    with _files_side_by_side(df.sparkSession):
        writer.parquet(path)
    return counted.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# Used where the cluster names no shared folder.  Without a scheme, Hadoop resolves it on the
# default file system, which every executor reaches.
DEFAULT_SCRATCH = "/tmp/facilitymetrics-scratch"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory name in the folder shared by the executors (``spark.checkpoint.dir``).

    Without that setting only a session on one machine may fall back on its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        local = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///").startswith("file:")
        if local and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = DEFAULT_SCRATCH
    return _join(shared, f"{name}-{uuid.uuid4()}")
