"""Clustered and incremental curation, summary upkeep, roll-ups in one pass, quarantine, audits and Bloom filters."""

import os

import pytest
from pyspark.sql import functions as F

import facility_rows as rows
from facilitymetrics import jobs
from facilitymetrics.operators.joins import of_selected
from facilitymetrics.operators.select import FacilityFilter
from facilitymetrics.plans import rollups, staffing
from facilitymetrics.plans.curate import curate, curate_clustered
from facilitymetrics.plans.summary import Summary, staffing_summary
from facilitymetrics.schemas import CCN, PBJ, REFINED, STATE_AVERAGES
from facilitymetrics.sources import clustering, manifest
from facilitymetrics.sources.audit import TypeBoundary
from facilitymetrics.sources.lake import Lake, read_curated, read_parquet, write_parquet
from facilitymetrics.sources.quarantine import checked_schema, read_checked


def day(ccn, date, quarter, hours=8.0, name="ALPHA"):
    return (ccn, name, "AL", date, quarter) + (hours,) * 13


def many_days(spark, n=3000):
    """Half of the rows in one quarter, a quarter missing, copies of rows."""
    quarters = ["2024Q4"] * 5 + ["2024Q3", "2024Q2", "2024Q1", None, "a=b/c d"]
    data = [day(f"f{k % 70}", 20240101 + k % 28, quarters[k % 10], float(k % 11)) for k in range(n)]
    return rows.refined_pbj(spark, data).repartition(4)


def bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [x for x in plan_of(df).splitlines() if "Exchange" in x and "Broadcast" not in x]


@pytest.fixture
def lake(tmp_path):
    return Lake(refined=f"{tmp_path}/refined", curated=f"{tmp_path}/curated")


# ---- one exchange for deduplication and write

def test_clustered_curation_has_one_exchange_and_the_same_rows(spark, tmp_path, monkeypatch):
    many_days(spark).write.parquet(f"{tmp_path}/in")
    source = spark.read.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(clustering, "SAMPLED_PER_TASK", 40)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        curated, clustered = curate_clustered(source, PBJ, ["CY_Qtr"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert clustered and len(exchanges(curated)) == 1
    assert "CY_Qtr" in exchanges(curated)[0] and "_row_bucket" in exchanges(curated)[0]
    assert len(exchanges(curate(source, PBJ).hint("rebalance", "CY_Qtr"))) == 2
    assert bag(curated) == bag(curate(source, PBJ))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        # The quarter with half of the rows is in several tasks, the small ones in no more than their size asks for.
        placed = curated.select("CY_Qtr", F.spark_partition_id().alias("task")).distinct()
        tasks = {r[0]: r[1] for r in placed.groupBy("CY_Qtr").count().collect()}
        count = write_parquet(curated, f"{tmp_path}/out", ["CY_Qtr"], clustered=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert tasks["2024Q4"] >= 4 and tasks["2024Q1"] <= 2 and tasks[None] <= 2
    assert count == curated.count()
    assert bag(read_parquet(spark, f"{tmp_path}/out")) == bag(curated)


def test_copies_of_one_row_are_deduplicated_apart(spark, tmp_path):
    copies = rows.refined_pbj(spark, [day("hot", 20240101, "2024Q4")] * 3000)
    source = many_days(spark).union(copies.repartition(4))
    source.write.parquet(f"{tmp_path}/in")
    source = spark.read.parquet(f"{tmp_path}/in")
    curated, clustered = curate_clustered(source, PBJ, ["CY_Qtr"])
    assert clustered and "Union" in plan_of(curated)
    assert bag(curated) == bag(curate(source, PBJ))


def test_very_many_partition_values_fall_back(spark, monkeypatch):
    monkeypatch.setattr(clustering, "MOST_VALUES", 2)
    curated, clustered = curate_clustered(many_days(spark), PBJ, ["CY_Qtr"])
    assert not clustered and bag(curated) == bag(curate(many_days(spark), PBJ))


def test_nothing_to_cluster(spark):
    curated, _ = curate_clustered(many_days(spark).limit(0), PBJ, ["CY_Qtr"])
    assert curated.count() == 0


# ---- incremental curation

def _write(spark, lake, data, only=False):
    write_parquet(rows.refined_pbj(spark, data), lake.refined_path(PBJ), ["CY_Qtr"], touched_partitions_only=only)


def _curated_files(lake):
    found = {}
    for folder, _, names in os.walk(lake.curated_path(PBJ)):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.join(folder, name)] = os.stat(os.path.join(folder, name)).st_mtime_ns
    return found


def test_only_changed_quarters_are_read(spark, lake, monkeypatch):
    old = [day("1", 20240101, "2024Q1"), day("1", 20240401, "2024Q2"), day("2", 20240401, None), day("3", 20230101, "2023Q1")]
    _write(spark, lake, old)
    assert jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True) == 4
    assert jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True) == 0
    before = _curated_files(lake)

    read = []
    original = jobs.curate_clustered
    monkeypatch.setattr(jobs, "curate_clustered", lambda df, *a: read.append(df) or original(df, *a))
    # One quarter is new, one corrected, one gone.
    _write(spark, lake, [day("1", 20240701, "a=b/c d"), day("1", 20240401, "2024Q2", 5.0), day("4", 20240402, "2024Q2")], only=True)
    manifest.drop_partition(spark, lake.refined_path(PBJ), ["CY_Qtr"], ["2023Q1"])
    assert jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True) == 3
    assert {r[0] for r in read[0].select("CY_Qtr").distinct().collect()} == {"a=b/c d", "2024Q2"}
    scan = next(x for x in plan_of(read[0]).splitlines() if "FileScan" in x)
    assert "PartitionFilters: [" in scan and "2024Q2" in scan.split("PartitionFilters:")[1].split("]")[0]
    after = _curated_files(lake)
    untouched = [f for f in before if "2024Q1" in f or "HIVE" in f]
    assert untouched and all(after[f] == before[f] for f in untouched)
    whole = curate(spark.read.parquet(lake.refined_path(PBJ)), PBJ)
    assert bag(read_curated(spark, lake, PBJ)) == bag(whole)


def test_missing_quarter_is_a_partition_of_its_own(spark, lake):
    _write(spark, lake, [day("1", 20240101, "2024Q1"), day("2", 20240401, None)])
    jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True)
    _write(spark, lake, [day("2", 20240402, None), day("2", 20240403, None)], only=True)
    assert jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True) == 2
    manifest.drop_partition(spark, lake.refined_path(PBJ), ["CY_Qtr"], [None])
    assert jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True) == 0
    assert [r["CY_Qtr"] for r in read_curated(spark, lake, PBJ).collect()] == ["2024Q1"]


def test_files_without_partition_directories_are_read_in_full(spark, lake):
    source = rows.refined_pbj(spark, [day("1", 20240101, "2024Q1"), day("1", 20240401, "2024Q2")])
    source.write.parquet(lake.refined_path(PBJ))
    for _ in range(2):
        assert jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True) == 2


def test_renamed_partition_column(spark, lake):
    source = rows.refined_pbj(spark, [day("1", 20240101, "2024Q1")])
    write_parquet(source, lake.refined_path(PBJ), ["STATE"])
    assert jobs.curate_dataset(spark, lake, PBJ, ["state"], changed_only=True) == 1
    assert jobs.curate_dataset(spark, lake, PBJ, ["state"], changed_only=True) == 0


# ---- summary upkeep

def test_summary_is_kept_by_quarter(spark, lake, tmp_path):
    out = f"{tmp_path}/reports"
    path = f"{out}/staffing_summary_by_quarter"
    _write(spark, lake, [day("1", 20240101, "2024Q1"), day("1", 20240401, "2024Q2"), day("3", 20230101, "2023Q1"), day("2", 1, None)])
    jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True)
    assert jobs.update_summary(spark, lake, out) == 4
    _write(spark, lake, [day("1", 20240401, "2024Q2", 5.0), day("1", 20240701, "2024Q3"), day("2", 20240101, None)], only=True)
    manifest.drop_partition(spark, lake.refined_path(PBJ), ["CY_Qtr"], ["2023Q1"])
    jobs.curate_dataset(spark, lake, PBJ, ["CY_Qtr"], changed_only=True)
    assert jobs.update_summary(spark, lake, out, ["2024Q2", "2024Q3", "2023Q1", None]) == 3
    fresh = staffing_summary(read_curated(spark, lake, PBJ))
    assert bag(read_parquet(spark, path)) == bag(fresh)
    jobs.main(["summary", "--curated", lake.curated, "--out", out, "--quarter", "2024Q2"])
    assert bag(read_parquet(spark, path)) == bag(fresh)


# ---- roll-ups in one pass

def test_all_rollups_read_the_summary_once(spark, pbj, tmp_path):
    staffing_summary(pbj).write.parquet(f"{tmp_path}/summary")
    summary = Summary(spark.read.parquet(f"{tmp_path}/summary"))
    table = rollups.all_rollups(summary)
    assert plan_of(table).count("FileScan") == 1 and plan_of(table).count("Expand") >= 1
    single = {
        "facility": rollups.monthly_hours, "month": rollups.hours_by_month, "state": rollups.hours_by_state,
        "provider": rollups.hours_by_provider,
    }
    for source in (summary, pbj):
        for level, build in single.items():
            found = rollups.rollup_of(rollups.all_rollups(source), level)
            expected = build(source)
            assert found.columns == expected.columns and bag(found) == bag(expected)
            if level != "facility":
                assert found.collect() == expected.collect()


# ---- quarantine

BROKEN = (
    "State or Nation,Cycle 1 Total Number of Health Deficiencies,Beds,Share,Day,Note\n"
    "AL,5.0,10,1,2024-10-01,x\n"
    "AL,5.0,10,1,2024-10-01,x\n"
    "AK,many,10,0.5,2024-10-01,\n"
    "AZ,1.0\n"
    'CA,"1,234.5",7,1,2024-10-02,y\n'
    "GU,,8,2,2024-10-03,7\n"
)


def test_broken_rows_are_kept_apart(spark, tmp_path, lake):
    (tmp_path / "raw.csv").write_text(BROKEN)
    path = str(tmp_path / "raw.csv")
    kinds = {f.name: f.dataType.simpleString() for f in checked_schema(spark, path, REFINED[STATE_AVERAGES]).fields}
    assert (kinds["Beds"], kinds["Share"], kinds["Day"], kinds["Note"]) == ("int", "double", "date", "string")
    checked = read_checked(spark, path, f"{tmp_path}/staging", REFINED[STATE_AVERAGES])
    lines = BROKEN.splitlines()
    assert checked.n_broken == 3
    assert sorted(map(tuple, checked.broken.collect())) == sorted([(lines[3], "value"), (lines[4], "fields"), (lines[5], "value")])
    good = {r["State or Nation"]: tuple(r)[1:4] for r in checked.good.collect()}
    assert good == {"AL": (5.0, 10, 1.0), "AK": (None, 10, 0.5), "CA": (None, 7, 1.0), "GU": (None, 8, 2.0)}
    assert "FileScan csv" not in plan_of(checked.good)
    assert jobs.refine(spark, path, lake) == 4
    assert read_parquet(spark, lake.quarantine_path(STATE_AVERAGES)).count() == 3
    assert read_parquet(spark, lake.refined_path(STATE_AVERAGES)).count() == 4


def test_a_later_value_that_fits_no_guess_is_kept(spark, tmp_path, monkeypatch):
    from facilitymetrics.sources import quarantine

    monkeypatch.setattr(quarantine, "HEAD_ROWS", 1)
    (tmp_path / "raw.csv").write_text("State or Nation,Beds\nAL,1\nAK,many\n")
    checked = read_checked(spark, str(tmp_path / "raw.csv"), f"{tmp_path}/staging", REFINED[STATE_AVERAGES])
    assert [tuple(r) for r in checked.broken.collect()] == [("AK,many", "value")]
    assert sorted(map(tuple, checked.good.select("State or Nation", "Beds").collect())) == [("AK", None), ("AL", 1)]


def test_empty_csv(spark, tmp_path, lake):
    (tmp_path / "raw.csv").write_text(BROKEN.splitlines()[0] + "\n")
    assert jobs.refine(spark, str(tmp_path / "raw.csv"), lake) == 0


# ---- values lost at the type boundary

def test_lost_values_are_counted_by_the_write(spark, tmp_path, lake):
    source = rows.refined_pbj(spark, [day("1", 20240101, "2024Q1"), day("1", 20240102, "2024Q1"), day(None, None, "2024Q2")])
    source = source.withColumns({
        "Hrs_RN": F.when(F.col("WorkDate") == 20240101, "1,234.5").otherwise("8"),
        "Hrs_CNA": F.when(F.col("WorkDate") == 20240102, float("nan")).otherwise(F.lit(None)),
    })
    source.write.partitionBy("CY_Qtr").parquet(lake.refined_path(PBJ))
    for partitions in ([], ["CY_Qtr"]):
        assert jobs.curate_dataset(spark, lake, PBJ, partitions) == 3
        audit = {r["column_name"]: tuple(r)[1:] for r in read_parquet(spark, lake.audit_path(PBJ)).collect()}
        assert audit["Hrs_RN"] == (1, 3, 3) and audit["Hrs_CNA"] == (1, 3, 3) and audit["Hrs_LPN"] == (0, 3, 3)
    boundary = TypeBoundary(REFINED[STATE_AVERAGES])
    text = spark.createDataFrame([("x",)], "other string")
    boundary.watched(text).collect()
    assert [tuple(r) for r in boundary.table(text, 1).collect()] == [(None, 0, 1, 1)]


# ---- facilities once

def test_facilities_are_read_once_and_nothing_is_sorted_to_group(spark, pbj, provider, tmp_path):
    pbj.write.parquet(f"{tmp_path}/days")
    provider.write.parquet(f"{tmp_path}/facilities")
    days, facilities = spark.read.parquet(f"{tmp_path}/days"), spark.read.parquet(f"{tmp_path}/facilities")
    for build in (staffing.staffing_kpis, staffing.provider_detail):
        plan = plan_of(build(days, facilities))
        scans = [x for x in plan.splitlines() if "FileScan" in x]
        assert len(scans) == 2 and sum("Total_Nurse_Hrs" in x for x in scans) == 1
        assert "SortAggregate(key=[cms" not in plan and "SortMergeJoin" not in plan
    assert "SortAggregate" not in plan_of(staffing.staffing_kpis(days, facilities))


# ---- Bloom filter before the shuffle

def _shuffled_rows(df):
    """Rows written by each shuffle of an executed plan."""
    df.collect()
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            if kind.startswith("Shuffle"):
                found.append(node.shuffle().metrics().apply("shuffleRecordsWritten").value())
            return walk(node.plan())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("missing", [False, True])
def test_a_narrow_selection_shuffles_its_own_rows(spark, tmp_path, missing):
    spark.range(20_000).selectExpr(
        f"if(id % 3 = 0, null, concat('f', id % 1000)) AS {CCN}", "double(id) AS Total_Nurse_Hrs"
    ).write.parquet(f"{tmp_path}/days")
    spark.range(1000).selectExpr(
        f"if(id = 101 and {str(missing).lower()}, null, concat('f', id)) AS {CCN}",
        "if(id % 100 = 1, 'few', 'many') AS ownership_type", "'AL' AS state", "'x' AS provider_name",
    ).write.parquet(f"{tmp_path}/facilities")
    days, facilities = spark.read.parquet(f"{tmp_path}/days"), spark.read.parquet(f"{tmp_path}/facilities")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        # A stand-in for a large table: the filter is built for scans of over 10 GB.
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        chosen = of_selected(days, FacilityFilter(owner="few").full_scope(facilities))
        plan, shuffled = plan_of(chosen), _shuffled_rows(chosen)
        got = chosen.count()
    finally:
        for key in settings:
            spark.conf.unset(key)
    ids = {r[0] for r in facilities.where("ownership_type = 'few'").collect()}
    expected = sum(r[0] in ids for r in days.collect())
    assert "might_contain" in plan and got == expected
    assert (None in ids) == missing
    # 1% of the known ids; with a missing id in the selection also the third of rows without one.
    assert expected <= max(shuffled) <= expected + 100


def test_deduplicating_tasks_grow_in_number_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(clustering, "ROWS_PER_TASK", 50)
    table = spark.range(0, 1000, 1, 3).selectExpr("id", "id % 3 AS part")
    table = table.union(table.where("id < 100"))
    found = clustering.clustered_distinct(table, ["part"])
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    # More than the session's 4 shuffle partitions.
    assert sum(sizes) == 1000 and len(sizes) > 8 and max(sizes) < 300
    assert sorted(r["id"] for r in found.collect()) == list(range(1000))
