"""Sources, sinks, audits and the command line jobs on small files."""

import pytest
from pyspark.sql import DataFrameWriter

import facility_rows as rows
from facilitymetrics import jobs
from facilitymetrics.operators.select import FacilityFilter
from facilitymetrics.plans import rollups
from facilitymetrics.schemas import (
    CCN,
    CYCLE_DEFICIENCIES,
    DATASETS,
    PBJ,
    PROVIDER_INFO,
    QUALITY,
    REFINED,
    STATE_AVERAGES,
)
from facilitymetrics.sources import lake as lake_module
from facilitymetrics.sources.audit import dataset_audit, schema_findings, undated_rows
from facilitymetrics.sources.lake import (
    Lake,
    read_csv,
    read_curated,
    read_parquet,
    scratch_dir,
    write_parquet,
)

CSV = (
    f"State or Nation,{','.join(CYCLE_DEFICIENCIES)},Beds,Processing Date\n"
    "AL,5.0,7.5,6.0,10,2024-10-01\n"
    "AL,5.0,7.5,6.0,10,2024-10-01\n"
    "NATION,,4.0,,20,2024-10-01\n"
    "GU,,,unknown,30,2024-10-01\n"
)


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "averages.csv"
    path.write_text(CSV)
    return str(path)


@pytest.fixture
def lake(tmp_path):
    return Lake(refined=f"{tmp_path}/refined", curated=f"{tmp_path}/curated/")


def test_csv_types(spark, csv_path):
    types = dict(read_csv(spark, csv_path, REFINED[STATE_AVERAGES]).dtypes)
    assert types["State or Nation"] == "string"
    assert {types[name] for name in CYCLE_DEFICIENCIES} == {"double"}
    assert types["Processing Date"] == "date"
    assert types["Beds"] == "int"  # not declared, hence inferred
    kept_as_text = read_csv(spark, csv_path, REFINED[STATE_AVERAGES], infer_rest=False)
    assert dict(kept_as_text.dtypes)["Beds"] == "string"
    assert dict(read_csv(spark, csv_path).dtypes)["Beds"] == "int"


def test_identifiers_keep_leading_zeros(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("PROVNUM,Hrs_RN\n015009,8\n")
    assert rows.as_tuples(read_csv(spark, str(path), REFINED[PBJ])) == [("015009", 8.0)]


def test_state_averages_from_csv_to_curated(spark, csv_path, lake):
    for _ in range(2):  # overwriting gives the same tables again
        assert jobs.refine(spark, csv_path, lake) == 3
        assert jobs.curate_dataset(spark, lake, STATE_AVERAGES) == 3
    curated = read_curated(spark, lake, STATE_AVERAGES)
    assert sorted(
        rows.as_tuples(
            curated, "state", "all_cycle_total_health_deficiencies",
            "total_health_deficiencies_range", "Beds",
        )
    ) == [("AL", 18.5, 2.5, 10), ("GU", 0.0, None, 30), ("NATION", 4.0, 0.0, 20)]


def test_write_counts_rows_and_replaces_the_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert write_parquet(spark.range(10), path) == 10
    assert write_parquet(spark.range(3), path) == 3
    assert read_parquet(spark, path).count() == 3


def test_partitioned_writes(spark, tmp_path):
    path = f"{tmp_path}/table"
    rows_of = "id", "CASE WHEN id < 6 THEN 'a' ELSE 'b' END AS part"
    assert write_parquet(spark.range(10).selectExpr(*rows_of), path, ["part"]) == 10
    only_b = spark.range(6, 8).selectExpr(*rows_of)
    assert write_parquet(only_b, path, ["part"], touched_partitions_only=True) == 2
    assert read_parquet(spark, path).groupBy("part").count().orderBy("part").collect() == [
        ("a", 6), ("b", 2),
    ]
    assert write_parquet(only_b, path, ["part"]) == 2
    assert read_parquet(spark, path).count() == 2


def test_scratch_folder_is_in_the_shared_one_named_by_the_session(spark, shared_dir):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{shared_dir}/x-") and first != second


def test_audit(spark, refined_pbj):
    source = refined_pbj.drop("Hrs_RN").selectExpr(
        "* EXCEPT (WorkDate, Hrs_LPN)", "string(WorkDate) AS WorkDate",
        "int(Hrs_LPN) AS Hrs_LPN", "1 AS extra",
    )
    status = {name: state for name, _, _, state in schema_findings(source, REFINED[PBJ])}
    assert status["Hrs_RN"] == "missing"
    assert status["Hrs_LPN"] == "other type"
    assert status["WorkDate"] == "ok"
    assert status["extra"] == "extra"
    audit = dataset_audit(source, REFINED[PBJ])
    assert audit.count() == len(status)
    assert {row["row_count"] for row in audit.collect()} == {5}


def test_undated_rows_are_counted(spark):
    undated = rows.PLAIN[:3] + (None,) + rows.PLAIN[4:]
    unreadable = rows.PLAIN[:3] + (20249901,) + rows.PLAIN[4:]
    source = rows.refined_pbj(spark, [rows.PLAIN, undated, unreadable])
    assert rows.as_tuples(undated_rows(source)) == [(3, 2)]


def _fill_refined(spark, lake, refined_pbj, refined_provider):
    refined_pbj.write.parquet(lake.refined_path(PBJ))
    refined_provider.write.parquet(lake.refined_path(PROVIDER_INFO))
    rows.refined_quality(spark, [(1.0, 2.0, 3.0, 4.0)] * 2).write.parquet(
        lake.refined_path(QUALITY)
    )
    rows.refined_state_averages(spark, [("AL", 1.0, 2.0, 3.0)]).write.parquet(
        lake.refined_path(STATE_AVERAGES)
    )


def test_curation_jobs_are_repeatable(spark, lake, refined_pbj, refined_provider):
    _fill_refined(spark, lake, refined_pbj, refined_provider)
    for _ in range(2):
        written = {name: jobs.curate_dataset(spark, lake, name) for name in DATASETS}
        assert written == {PBJ: 4, PROVIDER_INFO: 3, QUALITY: 1, STATE_AVERAGES: 1}
    assert {row[CCN] for row in read_curated(spark, lake, PBJ).collect()} == {
        "015009", "025010",
    }


def test_report_job(spark, lake, tmp_path, refined_pbj, refined_provider, pbj):
    _fill_refined(spark, lake, refined_pbj, refined_provider)
    jobs.curate_dataset(spark, lake, PBJ, partition_by=["CY_Qtr"])
    jobs.curate_dataset(spark, lake, PROVIDER_INFO)
    out = f"{tmp_path}/reports"
    written = jobs.build_reports(spark, lake, out, FacilityFilter(state="AL"))
    assert written["occupancy_ranking"] == 2
    assert written["record_completeness"] == 2
    assert written["staffing_mix"] == 2
    assert read_parquet(spark, f"{out}/hours_by_month").orderBy("month").collect() == (
        rollups.hours_by_month(pbj).collect()
    )
    kpis = read_parquet(spark, f"{out}/staffing_kpis").first()
    assert (kpis["providers"], kpis["total_employee_hrs"]) == (2, 80.0)
    assert jobs.build_reports(spark, lake, f"{out}-empty", FacilityFilter(state="ZZ"))[
        "occupancy_ranking"
    ] == 0
    for name, count in written.items():
        assert read_parquet(spark, f"{out}/{name}").count() == count


def test_command_line(spark, csv_path, lake):
    jobs.main(["refine", "--csv", csv_path, "--refined", lake.refined])
    jobs.main(
        ["curate", STATE_AVERAGES, "--refined", lake.refined, "--curated", lake.curated]
    )
    assert read_curated(spark, lake, STATE_AVERAGES).count() == 3


def test_csv_files_with_other_header_order_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("State,Cycle\nAL,1\n")
    (tmp_path / "b.csv").write_text("Cycle,State\n7,AK\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), infer_rest=False).collect()


def test_partitions_are_written_side_by_side_without_a_sort(spark, tmp_path, monkeypatch):
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    parquet = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: seen.append(spark.conf.get(key)) or parquet(self, *a, **b))
    # More values in one task than files side by side, in mixed order, one of them null.
    values = 3 * lake_module.OPEN_FILES
    table = spark.range(0, 500, 1, 1).selectExpr("id", f"nullif(id % {values}, 1) AS part")
    path = f"{tmp_path}/parts"
    assert write_parquet(table, path, ["part"], clustered=True) == 500
    assert seen == [str(lake_module.OPEN_FILES)] and spark.conf.get(key) == "0"
    back = [tuple(r) for r in read_parquet(spark, path).select("id", "part").collect()]
    assert sorted(back, key=str) == sorted(((k, None if k % values == 1 else k % values) for k in range(500)), key=str)
    # A failed write leaves the session as it was; a number of the session's own stays.
    spark.conf.set(key, "3")
    try:
        with pytest.raises(Exception, match="raised"):
            write_parquet(table.selectExpr("raise_error('raised') AS x", "part"), path, ["part"])
        assert seen[1:] == ["3"] and spark.conf.get(key) == "3"
    finally:
        spark.conf.set(key, "0")
