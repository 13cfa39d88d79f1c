"""Compare every registered query with its SQL counterpart in DuckDB.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    return db


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(value + 0.0)
    if isinstance(value, int):
        return str(value)
    return str(value)


def normal_rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when names and the bag of rows agree, to the last bit of every number."""
    cursor = db.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    expected = normal_rows(names, cursor.fetchall())
    actual = normal_rows(frame.columns, frame.collect())
    if actual == expected:
        return ""
    extra = [row for row in actual if row not in set(expected)][:3]
    missing = [row for row in expected if row not in set(actual)][:3]
    return f"{len(actual)} rows, expected {len(expected)}; only here {extra}, only there {missing}"


def main() -> int:
    import __spark_entry__ as entry
    from facilitymetrics.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in sql or (sys.argv[2:] and name not in sys.argv[2:]):
            continue
        start = time.time()
        problem = difference(query(spark, sf_dir), db, sql[name])
        bad += bool(problem)
        print(f"{name:40s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
