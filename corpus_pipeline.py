"""A training corpus from raw documents: five stages, each written and read again.

Stages 1 to 4 return the columns of ``documents``, the last one rows of packed pieces.

Whole texts go to Python and back in every stage.  Spark holds several copies of an Arrow batch outside the heap for each
task, so stages lower the session's bound on the bytes of a batch, where it is higher.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facilitymetrics.llm.decontam import without_leaks
from facilitymetrics.llm.near_dup import near_duplicates
from facilitymetrics.llm.packing import packed
from facilitymetrics.llm.queries import tokenizer_path
from facilitymetrics.llm.scratch import written
from facilitymetrics.llm.secrets import masked, scan_documents
from facilitymetrics.llm.toxicity import toxicity_scores

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Bytes of texts that go to a Python worker at a time.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(stage: Stage) -> Stage:
    """``stage`` with batches of bounded size; the bound stays, since the caller runs what the stage returns."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # Sizes may be written with a unit, as in 256MB.
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_KEY)) > BATCH_BYTES:
            spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


def _kept_apart(docs: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``change`` applied while other columns than id and text have names that nothing else uses."""
    other = {c: f"carried_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = change(docs.withColumnsRenamed(other))
    return out.select(*[F.col(other.get(c, c)).alias(c) for c in docs.columns])


@_in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted as toxic; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _kept_apart(docs, lambda d: toxicity_scores(d, labels).where("predicted = 0"))


@_in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Rows that repeat an id with the same shingles are one; texts without words all stay.
    """

    def change(d: DataFrame) -> DataFrame:
        kept = near_duplicates(d).where("kept")
        alone = kept.where("set_key is null")
        return kept.where("set_key is not null").dropDuplicates(["set_key", "doc_id"]).union(alone)

    return _kept_apart(docs, change)


@_in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_in_small_batches
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and ``n_chars`` of changed texts renewed."""

    def change(d: DataFrame) -> DataFrame:
        return masked(scan_documents(d))

    out = _kept_apart(docs.withColumn("n_chars_before", F.length("text")), change)
    if "n_chars" in docs.columns:
        changed = ~F.length("text").eqNullSafe(F.col("n_chars_before"))
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@_in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    return packed(docs, tokenizer_path(), 2048, tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# No stage but the secret scan could be put in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
