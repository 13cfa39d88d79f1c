"""The ledger of secret scans under repeated and overlapping jobs."""

from facilitymetrics.llm import secrets
from facilitymetrics.llm.secrets import Ledger, scan_documents

KEY = "AKIA" + "Q" * 20


def test_repeated_appends_count_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, f"a {KEY}"), (2, "password = hunter22"), (3, f"a {KEY}")], "doc_id long, text string")
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    once = sorted(map(tuple, scan_documents(docs, ledger=ledger).collect()))
    spark.read.parquet(ledger.path).write.parquet(f"{tmp_path}/copy")
    spark.read.parquet(f"{tmp_path}/copy").write.mode("append").parquet(ledger.path)  # a job that ran twice
    assert spark.read.parquet(ledger.path).count() == 4 and ledger.rows().count() == 2
    assert sorted(map(tuple, scan_documents(docs, ledger=ledger).collect())) == once


def test_a_second_scan_reads_only_new_blobs_and_rules(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    first = spark.createDataFrame([(1, f"a {KEY}"), (2, None)], "doc_id long, text string")
    more = first.union(spark.createDataFrame([(3, "token: abcdef1"), (4, f"a {KEY}")], first.schema))
    scan_documents(first, ledger=ledger).collect()
    assert spark.read.parquet(ledger.path).count() == 2
    found = scan_documents(more, ledger=ledger)
    assert spark.read.parquet(ledger.path).count() == 3  # only the unseen text was scanned
    fresh = scan_documents(more)
    assert sorted(map(str, found.collect())) == sorted(map(str, fresh.collect()))
    monkeypatch.setattr(secrets, "RULE_VERSION", "2")
    scan_documents(more, ledger=ledger).collect()
    assert spark.read.parquet(ledger.path).count() == 6
