"""Raw CSV with broken rows: read once, good rows on one side, what could not be read on the other.

Declared columns have their declared type; types of the others are guessed from the first ``HEAD_ROWS`` rows, which is
no pass over the data.  A row with other than the header's number of fields is left out.  A row with a field that
is not of its column's type stays, with null in that field.  Both are kept as text in the quarantine, with the reason
(``fields`` or ``value``), and counted, so nothing is lost silently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD_ROWS = 10_000
RAW_ROW = "_raw_row"
# Narrowest type first.
_GUESSES = (T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType())


@dataclass(frozen=True)
class Checked:
    """Good rows; ``raw_row`` and ``reason`` of rows that could not be read in full, and their number."""

    good: DataFrame
    broken: DataFrame
    n_broken: int


def checked_schema(spark: SparkSession, path: str, declared: T.StructType | None = None) -> T.StructType:
    """Declared types, and for the other columns of the header the narrowest type that the head's values have."""
    head = spark.read.option("header", True).csv(path).limit(HEAD_ROWS)
    known = {} if declared is None else {f.name.lower(): f.dataType for f in declared.fields}
    rest = [name for name in head.columns if name.lower() not in known]
    guessed: dict[str, T.DataType] = {}
    if rest:
        tests = [
            (F.count_if(F.col(f"`{name}`").isNotNull() & F.col(f"`{name}`").try_cast(kind).isNull()) == 0).alias(f"fits_{k}_{g}")
            for k, name in enumerate(rest)
            for g, kind in enumerate(_GUESSES)
        ]
        any_value = [(F.count(f"`{name}`") > 0).alias(f"any_{k}") for k, name in enumerate(rest)]
        seen = head.agg(*tests, *any_value).first()
        for k, name in enumerate(rest):
            fits = [kind for g, kind in enumerate(_GUESSES) if seen[f"any_{k}"] and seen[f"fits_{k}_{g}"]]
            guessed[name] = fits[0] if fits else T.StringType()
    return T.StructType(
        [T.StructField(name, known.get(name.lower(), guessed.get(name, T.StringType())), True) for name in head.columns]
    )


def read_checked(spark: SparkSession, path: str, staging: str, declared: T.StructType | None = None) -> Checked:
    """The CSV files, parsed once into ``staging`` (Parquet), from which good and broken rows are then read."""
    schema = checked_schema(spark, path, declared)
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_ROW)
        .schema(T.StructType([*schema.fields, T.StructField(RAW_ROW, T.StringType(), True)]))
        .csv(path)
    )
    counted = Observation()
    raw.observe(counted, F.count(RAW_ROW).alias("broken")).write.mode("overwrite").parquet(staging)
    stored = spark.read.parquet(staging)
    # Text alone fits any field, so what is still broken has another number of fields.
    as_text = ", ".join(f"`{name}` string" for name in [*schema.names, RAW_ROW])
    parsed = F.from_csv(RAW_ROW, as_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_ROW})
    reason = F.when(parsed[RAW_ROW].isNotNull(), "fields").otherwise("value")
    marked = stored.withColumn("_reason", F.when(F.col(RAW_ROW).isNotNull(), reason))
    return Checked(
        marked.where("_reason is null or _reason = 'value'").drop(RAW_ROW, "_reason"),
        marked.where("_reason is not null").select(F.col(RAW_ROW).alias("raw_row"), F.col("_reason").alias("reason")),
        counted.get["broken"],
    )
