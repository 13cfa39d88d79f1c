"""Deduplication that also clusters rows for a partitioned write, so whole rows are shuffled once.

Rows go to tasks by the columns they are written by and a bucket of the row's hash.  Equal rows share
both, so deduplication needs no exchange of its own, and the write finds a partition value's
rows in as many tasks as its size asks for: large values are split, small ones are in one task.

Copies of one row share a bucket too.  Where they could fill half a task or more, which a sample of the row hashes shows
(``SAMPLED_PER_TASK`` rows for each task), they are deduplicated apart, with the copies of each task collapsing before a
shuffle.  The sample only decides the route of a row, never whether it is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from facilitymetrics.operators.aggs import deduplicated

SAMPLED_PER_TASK = 20
# Rows of a task on average at most, since deduplication holds all of them; there are as many tasks as that takes.
ROWS_PER_TASK = 250_000
# Directories of a partitioned table; beyond that many the sizes of partition values are not worth a broadcast.
MOST_VALUES = 10_000
_BUCKET, _BUCKETS, _HASH = "_row_bucket", "_row_buckets", "_row_hash"


def _same(df: DataFrame, sizes: DataFrame, columns: Sequence[str]) -> Column:
    terms = [df[name].eqNullSafe(sizes[f"_size_{k}"]) for k, name in enumerate(columns)]
    same = terms[0]
    for term in terms[1:]:
        same = same & term
    return same


def clustered_distinct(
    df: DataFrame,
    partition_by: Sequence[str],
    observed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """Distinct rows of ``df`` clustered for a write by ``partition_by``; None for too many partition values.

    Costs one more scan, which counts the partition values and the copies in a sample.  ``observed(df)``, if
    given, has the same rows and takes the place of ``df`` in the one full pass.
    """
    spark = df.sparkSession
    total = df.count()  # from the footers of Parquet files
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_TASK))
    if not total:
        return deduplicated(df)
    row_hash = F.xxhash64(*df.columns)
    counted = _sizes_and_copies(df, partition_by, row_hash, min(1.0, SAMPLED_PER_TASK * tasks / total))
    if counted is None:
        return None
    each = -(-total // tasks)
    names = [f"_size_{k}" for k in range(len(partition_by))]
    kinds = [df.select(name).schema[0].dataType.simpleString() for name in partition_by]
    sizes = spark.createDataFrame(
        [(*row[: len(partition_by)], -(-row["n"] // each)) for row in counted],
        ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds)) + f", {_BUCKETS} long",
    )
    copied = [(one,) for row in counted for one in row["copied"]]  # at most two for each task
    hot = spark.createDataFrame(copied, f"{_HASH} long") if copied else None
    # A row for each partition value, of which there are at most MOST_VALUES.
    rows = (observed(df) if observed else df).withColumn(_HASH, row_hash)
    if hot is not None:
        rows = rows.join(F.broadcast(hot), _HASH, "left_anti")
    rows = (
        rows.join(F.broadcast(sizes), _same(rows, sizes, partition_by), "left")
        .withColumn(_BUCKET, F.pmod(F.col(_HASH), F.coalesce(_BUCKETS, F.lit(1))))
        .select(*df.columns, _BUCKET)
    )
    # With a number, as adaptive execution would merge tasks by compressed size, several times less than they hold in memory.
    distinct = rows.repartition(tasks, *partition_by, _BUCKET).dropDuplicates().drop(_BUCKET)
    if hot is None:
        return distinct
    copies = df.withColumn(_HASH, row_hash).join(F.broadcast(hot), _HASH, "left_semi").select(*df.columns)
    return distinct.union(deduplicated(copies))


def _sizes_and_copies(
    df: DataFrame, partition_by: Sequence[str], row_hash: Column, fraction: float
) -> list[Row] | None:
    """For each partition value its rows ``n``, and the hashes ``copied`` of rows whose copies would be half a task or more.

    One scan: rows of the sample are counted by hash, the others together.  None for too many values.
    """
    sampled = F.when(F.rand(1) < fraction, row_hash) if fraction < 1 else row_hash
    frequent = F.col(_HASH).isNotNull() & (F.col("n") >= max(2, SAMPLED_PER_TASK // 2))
    found = (
        df.withColumn(_HASH, sampled)
        .groupBy(*partition_by, _HASH)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*partition_by)
        .agg(F.sum("n").alias("n"), F.collect_list(F.when(frequent, F.col(_HASH))).alias("copied"))
        .limit(MOST_VALUES + 1)
        .collect()
    )
    return found if len(found) <= MOST_VALUES else None
