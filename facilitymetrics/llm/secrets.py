"""Secret scans over an incremental ledger of content-addressed blobs.

A blob is a distinct text, addressed by its SHA-256.  The ledger is a Parquet table with one
row for each pair of blob and rule version that has been scanned, with the spans found.  A scan
lists the addresses of all versions, scans one copy of each blob that the ledger lacks under the
current rules, appends the result, and joins findings back to every path that has the blob.
Addresses are computed by Spark; only unseen blobs reach Python, once each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facilitymetrics.llm.scratch import scratch_dir

RULE_VERSION = "1"
KINDS = ("assign", "access", "hex")
# The patterns of each kind and which group must have how many characters.
RULES = {
    "assign": (
        re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        2,
        6,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}


def find(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of every finding, by start and then kind."""
    found = []
    for rank, kind in enumerate(KINDS):
        pattern, group, least = RULES[kind]
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), rank, match.end()))
    return sorted(found)


def spans_text(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


_FINDINGS = "blob string, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find(text.as_py() or "") for text in batch.column(1)]
        spans = [spans_text(x) for x in found]
        counts = [[sum(1 for y in x if y[1] == k) for x in found] for k in range(len(KINDS))]
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([RULE_VERSION] * len(found)),
            *(pa.array(x, pa.int64()) for x in counts),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in spans]),
            pa.array(spans),
        ], names=["blob", "rule_version", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


class Ledger:
    """Findings by blob and rule version, in one Parquet directory."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_dir(spark, "ledger")

    def rows(self) -> DataFrame:
        """All recorded findings; repeated appends of a blob count once."""
        try:
            known = self.spark.read.schema(_FINDINGS).parquet(self.path)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], _FINDINGS)
        # Scans at the same time, or a job run again, append a blob more than once, with equal findings.
        return known.where(F.col("rule_version") == RULE_VERSION).dropDuplicates(["blob"])

    def scan(self, versions: DataFrame, text: str = "text") -> None:
        """Record findings for the texts of ``versions`` that have none under these rules."""
        content = F.coalesce(F.col(text), F.lit(""))
        blobs = versions.select(F.sha2(content, 256).alias("blob"), content.alias("content"))
        blobs = blobs.join(self.rows().select("blob"), "blob", "left_anti")
        # One copy of each; copies within a task fold before the shuffle.
        blobs = blobs.dropDuplicates(["blob"])
        blobs.mapInArrow(_scan, _FINDINGS).write.mode("append").parquet(self.path)


def scan_documents(docs: DataFrame, text: str = "text", ledger: Ledger | None = None) -> DataFrame:
    """``docs`` with ``blob``, the counts by kind, ``base_sha256`` and ``spans`` of its text.

    A null text counts as empty.  Equal texts, also in other rows with the same id, share one
    scan and get the same findings.  Columns of ``docs`` with these names are replaced.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.scan(docs.select(text), text)
    new = ["blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    docs = docs.drop(*[c for c in new if c != text])
    docs = docs.withColumn("blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return docs.join(ledger.rows().drop("rule_version"), "blob", "left")


MASK = "[SECRET]"


def masked(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with every span of its text replaced by a mark; overlapping spans by one."""
    columns = docs.columns
    at, found_at = columns.index(text), columns.index(spans)

    def cover(content: str | None, found: str | None) -> str | None:
        if not content or not found:
            return content
        out, done = [], 0
        for start, end in sorted(tuple(map(int, x.split(":")[1:])) for x in found.split(",")):
            if start >= done:
                out += [content[done:start], MASK]
            done = max(done, end)
        return "".join([*out, content[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [cover(a.as_py(), b.as_py()) for a, b in zip(batch.column(at), batch.column(found_at))]
            arrays = [*batch.columns]
            arrays[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(run, docs.schema)
