"""Row count and schema audit of a dataset."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facilitymetrics.functions.timeops import parse_workday
from facilitymetrics.schemas import DATE_LIKE
from facilitymetrics.sources.conform import lost_values


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_findings(df: DataFrame, declared: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, declared type, actual type, status) for declared and for extra columns."""
    actual = {field.name.lower(): field.dataType.simpleString() for field in df.schema.fields}
    wanted = {field.name.lower() for field in declared.fields}
    findings = []
    for field in declared.fields:
        want = field.dataType.simpleString()
        have = actual.get(field.name.lower())
        if have is None:
            status = "missing"
        elif have == want or field.name.lower() in DATE_LIKE:
            status = "ok"
        else:
            status = "other type"
        findings.append((field.name, want, have or "", status))
    findings += [
        (field.name, "", field.dataType.simpleString(), "extra")
        for field in df.schema.fields
        if field.name.lower() not in wanted
    ]
    return findings


def dataset_audit(df: DataFrame, declared: T.StructType) -> DataFrame:
    """One row per column with its finding and the table's row count, in one pass."""
    labels = ("column_name", "declared_type", "actual_type", "status")
    findings = F.array(
        *[
            F.struct(*[F.lit(value).alias(label) for label, value in zip(labels, finding)])
            for finding in schema_findings(df, declared)
        ]
    )
    counted = row_count(df)
    return counted.select("row_count", F.inline(findings)).select(*labels, "row_count")


def undated_rows(staffing: DataFrame, column: str = "WorkDate") -> DataFrame:
    """Rows whose work date is missing or unreadable, which monthly figures leave out."""
    return staffing.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(parse_workday(staffing, column).isNull()).alias("undated_rows"),
    )


@dataclass
class TypeBoundary:
    """Counts what the type boundary loses, in the pass that writes the table.

    Put ``watched`` around the table where it is read, and ask for ``table`` after the write.
    """

    declared: T.StructType
    _seen: Observation = field(default_factory=Observation)
    _names: list[str] = field(default_factory=list)

    def watched(self, df: DataFrame) -> DataFrame:
        losses = lost_values(df, self.declared)
        self._names = list(losses)
        counts = [count.alias(f"lost_{k}") for k, count in enumerate(losses.values())]
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows_read"), *counts)

    def table(self, df: DataFrame, rows_written: int) -> DataFrame:
        """A row for each checked column: values that became null, rows read and written."""
        seen = self._seen.get
        rows = [
            (name, seen[f"lost_{k}"], seen["rows_read"], rows_written) for k, name in enumerate(self._names)
        ] or [(None, 0, seen["rows_read"], rows_written)]
        return df.sparkSession.createDataFrame(
            rows, "column_name string, lost_values long, rows_read long, rows_written long"
        )
