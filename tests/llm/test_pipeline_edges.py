"""The pipeline over empty tables and null rows."""

import pyarrow as pa
import pytest

import corpus_pipeline
from facilitymetrics.llm import toxicity
from facilitymetrics.llm.queries import _table


def test_empty_tables(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("documents", "labels", "benchmark"):
        _table(spark, source, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_texts_go_to_python_in_batches_of_bounded_size(spark, name, stage):
    key, source = "spark.sql.execution.arrow.maxBytesPerBatch", "/root/testdata/sf0.001"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    before = spark.conf.get(key)
    long = spark.range(0, 40, 1, 1).selectExpr("repeat('x', 1000000) AS text").mapInArrow(sizes, "n long")
    try:
        spark.conf.set(key, "64MB")
        stage(spark, _table(spark, source, "documents").limit(5), source)
        # One text more than the bound at most.
        assert max(r["n"] for r in long.collect()) < corpus_pipeline.BATCH_BYTES + 1_100_000
        # A lower bound of the caller's stays.
        spark.conf.set(key, "1MB")
        stage(spark, _table(spark, source, "documents").limit(5), source)
        assert spark.conf.get(key) == "1MB"
    finally:
        spark.conf.set(key, before)


def test_toxicity_features_leave_a_worker_some_rows_at_a_time():
    rows = 3 * toxicity.ROWS + 5
    texts = pa.array([f"shared {'abcdefgh'[k % 8] * (3 + k // 8)}" for k in range(rows)])
    batch = pa.RecordBatch.from_arrays([texts, pa.array([0, 1] * (rows // 2) + [0] * (rows % 2)), pa.array([2] * rows)], names=["t", "x", "n"])
    found = list(toxicity._feature_counts(iter([batch])))
    assert [part.num_rows > 0 for part in found] == [True] * 4
    shared = [r for part in found for r in part.to_pylist() if r["feature"] == "1 =shared"]
    assert sum(r["toxic"] for r in shared) == 2 * (rows // 2)
    assert sum(r["toxic"] + r["clean"] for r in shared) == 2 * rows
