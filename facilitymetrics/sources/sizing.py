"""Task counts for a job, from the size of what it reads.

Adaptive execution merges shuffle partitions that turn out small but cannot add any, so the
number has to be large enough beforehand; Spark's default of 200 would make partitions of
hundreds of gigabytes out of a table of a hundred terabytes.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

MIB = 1 << 20
# Bytes of the plan's estimate for each shuffle partition.  Files on disk are several times smaller
# than the rows that a shuffle of whole rows moves.
PARTITION_BYTES = 128 * MIB
# The driver keeps a block list for each partition; more of them than this is worth a warning.
MANY_PARTITIONS = 200_000
_KEY = "spark.sql.shuffle.partitions"


def input_bytes(*tables: DataFrame) -> int:
    """Catalyst's size estimate of the tables: bytes on disk of scans, scaled by projections."""
    plans = [table._jdf.queryExecution().optimizedPlan() for table in tables]
    return sum(int(plan.stats().sizeInBytes()) for plan in plans)


def partitions_for(size: int, configured: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Shuffle partitions for ``size`` input bytes; never fewer than configured, without a ceiling."""
    wanted = max(configured, -(-size // partition_bytes))
    if wanted > MANY_PARTITIONS:
        log.warning("%d shuffle partitions for %d input bytes", wanted, size)
    return wanted


@contextmanager
def sized_tasks(spark: SparkSession, *tables: DataFrame) -> Iterator[None]:
    """The session's shuffle partitions follow the tables' size inside, and are restored after."""
    configured = spark.conf.get(_KEY)
    spark.conf.set(_KEY, str(partitions_for(input_bytes(*tables), int(configured))))
    try:
        yield
    finally:
        spark.conf.set(_KEY, configured)
