
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from facilitymetrics.functions import textfmt  # noqa: E402
from facilitymetrics.functions.timeops import month_label, parse_workday  # noqa: E402
from facilitymetrics.operators.aggs import deduplicated  # noqa: E402
from facilitymetrics.operators.joins import of_selected, with_state_name  # noqa: E402
from facilitymetrics.operators.reshape import renamed  # noqa: E402
from facilitymetrics.operators.select import (  # noqa: E402
    FacilityFilter,
    owner_options,
    provider_options,
    state_options,
)
from facilitymetrics import jobs  # noqa: E402
from facilitymetrics.plans import occupancy, rollups, staffing  # noqa: E402
from facilitymetrics.plans.curate import curate, curate_clustered, refine_state_averages  # noqa: E402
from facilitymetrics.plans.facility_staffing import facility_staffing  # noqa: E402
from facilitymetrics.plans.summary import (  # noqa: E402
    FACILITY,
    FACILITY_STATE,
    staffing_summary,
    with_quarters_replaced,
    with_rows_added,
)
from facilitymetrics.schemas import (  # noqa: E402
    CCN,
    PBJ,
    PROVIDER_INFO,
    QUALITY,
    REFINED,
    RENAMES,
    STATE_AVERAGES,
)
from facilitymetrics.sources.audit import TypeBoundary, dataset_audit, row_count, undated_rows  # noqa: E402
from facilitymetrics.sources.lake import (  # noqa: E402
    Lake,
    read_csv,
    read_curated,
    read_parquet,
    scratch_dir,
    write_csv,
    write_parquet,
)
from facilitymetrics.sources.manifest import drop_partition  # noqa: E402
from standins import curated, raw_state_averages, refined, table  # noqa: E402

# The operators on training text are a part that can be left out.
try:
    import corpus_pipeline
    from facilitymetrics.llm import queries as llm_queries
except ModuleNotFoundError as error:
    # Any other missing module is a fault of the installation.
    if error.name != "corpus_pipeline" and not (error.name or "").startswith("facilitymetrics.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# The choices of the filtered queries, which exercise the three scopes.
STATE, OWNER, PROVIDER = "CA", "ECONOMY", "FACILITY 1"
IN_STATE = FacilityFilter(state=STATE)
OF_OWNER = FacilityFilter(owner=OWNER)
ONE_PROVIDER = FacilityFilter(provider=PROVIDER)
NOTHING = FacilityFilter(state="ZZ")

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means of inexact ratios depend in the last digits on the order of addition."""
    return df.withColumns({column: F.round(column, 6) for column in columns})


def _iso_dates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.col(name).cast("string") for name, kind in df.dtypes if kind == "date"}
    )


def _underscored(df: DataFrame) -> DataFrame:
    """Labels with spaces in column-name form, for comparison by name."""
    return df.withColumnsRenamed(
        {name: name.lower().replace(" ", "_") for name in df.columns if " " in name}
    )


def _over(dataset: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(curated(spark, sf_dir, dataset))


def _over_both(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(
        curated(spark, sf_dir, PBJ), curated(spark, sf_dir, PROVIDER_INFO)
    )


def _rename_query(dataset: str) -> Query:
    return lambda spark, sf_dir: _underscored(
        _iso_dates(renamed(refined(spark, sf_dir, dataset), RENAMES[dataset]))
    )


def _with_copies(df: DataFrame) -> DataFrame:
    """The rows, and those of every eleventh hash once more, which deduplication must undo."""
    return df.union(df.where(F.pmod(F.xxhash64(*df.columns), F.lit(11)) == 0))


def _curate_query(dataset: str) -> Query:
    return lambda spark, sf_dir: _underscored(
        _iso_dates(curate(_with_copies(refined(spark, sf_dir, dataset)), dataset))
    )


def _audit_query(dataset: str) -> Query:
    return lambda spark, sf_dir: dataset_audit(
        refined(spark, sf_dir, dataset), REFINED[dataset]
    )


def _dedup_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return _iso_dates(deduplicated(_with_copies(rows)))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV to refined Parquet, read back."""
    root = scratch_dir(spark, "refine")
    write_csv(_with_copies(raw_state_averages(spark, sf_dir)), f"{root}/raw")
    raw = read_csv(spark, f"{root}/raw", REFINED[STATE_AVERAGES])
    write_parquet(refine_state_averages(raw), f"{root}/refined")
    return _underscored(_iso_dates(read_parquet(spark, f"{root}/refined")))


def _parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated facilities written over an older version of themselves, read back."""
    path = f"{scratch_dir(spark, 'curate')}/{PROVIDER_INFO}"
    facilities = curate(refined(spark, sf_dir, PROVIDER_INFO), PROVIDER_INFO)
    write_parquet(OF_OWNER.full_scope(facilities), path)
    write_parquet(facilities, path)
    return read_parquet(spark, path)


def _partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures written by measure period, read back."""
    path = f"{scratch_dir(spark, 'curate')}/{QUALITY}"
    periods = ["measure_period"]
    measures, clustered = curate_clustered(refined(spark, sf_dir, QUALITY), QUALITY, periods)
    write_parquet(measures, path, partition_by=periods, clustered=clustered)
    return _underscored(_iso_dates(read_parquet(spark, path)))


def _incremental_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures curated twice, the second time from the periods that came, changed or went alone."""
    root = scratch_dir(spark, "incremental")
    lake, periods, source = Lake(f"{root}/refined", f"{root}/curated"), ["measure_period"], "Measure Period"
    path = lake.refined_path(QUALITY)
    rows = refined(spark, sf_dir, QUALITY)
    odd = F.col(source).endswith("Q1")
    before = rows.where(~odd | (F.col("Q2 Measure Score") > 0)).withColumn(
        source, F.when(F.col(source) == "1995Q2", "1900Q1").otherwise(F.col(source))
    )
    write_parquet(before, path, [source])
    jobs.curate_dataset(spark, lake, QUALITY, periods, changed_only=True)
    write_parquet(rows.where(odd | (F.col(source) == "1995Q2")), path, [source], touched_partitions_only=True)
    drop_partition(spark, path, [source], ["1900Q1"])
    jobs.curate_dataset(spark, lake, QUALITY, periods, changed_only=True)
    return _underscored(_iso_dates(read_curated(spark, lake, QUALITY)))


def _csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV in which some numbers are none: rows refined and rows noted in the quarantine, by state."""
    root = scratch_dir(spark, "refine")
    score = "Cycle 1 Total Number of Health Deficiencies"
    bad = F.when(F.col("s_suppkey") % 11 == 0, F.concat(F.col("s_suppkey").cast("string"), F.lit(" and more")))
    raw = raw_state_averages(spark, sf_dir, "s_suppkey").withColumn(score, F.coalesce(bad, F.col(score).cast("string")))
    write_csv(raw.drop("s_suppkey"), f"{root}/raw")
    lake = Lake(f"{root}/refined", f"{root}/curated")
    jobs.refine(spark, f"{root}/raw", lake)
    good = read_parquet(spark, lake.refined_path(STATE_AVERAGES)).select(
        F.lit("refined").alias("status"), F.col("State or Nation").alias("state")
    )
    broken = read_parquet(spark, lake.quarantine_path(STATE_AVERAGES)).select(
        F.col("reason").alias("status"), F.split("raw_row", ",")[0].alias("state")
    )
    return good.union(broken).groupBy("status", "state").agg(F.count(F.lit(1)).alias("n"))


def _lost_values_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities whose measures are partly unreadable: values that the write turned into nulls, by column."""
    rows = refined(spark, sf_dir, PROVIDER_INFO)
    size = F.col("Number of Certified Beds")
    beds, residents, turnover = size, F.col("Average Number of Residents per Day"), F.col("Registered nurse turnover")
    rows = rows.withColumns(
        {
            "Number of Certified Beds": F.when(size % 9 == 4, "n/a").otherwise(beds.cast("string")),
            "Average Number of Residents per Day":
                F.when(size % 7 == 2, "1,234.5").otherwise(residents.cast("string")),
            "Registered nurse turnover":
                F.when((size % 5 == 3) & turnover.isNotNull(), float("nan")).otherwise(turnover),
        }
    )
    boundary = TypeBoundary(REFINED[PROVIDER_INFO])
    facilities = curate(boundary.watched(rows), PROVIDER_INFO)
    written = write_parquet(facilities, f"{scratch_dir(spark, 'curate')}/{PROVIDER_INFO}")
    return boundary.table(rows, written).drop("rows_written")


def _summary_quarters_replaced(pbj: DataFrame) -> DataFrame:
    """A summary with a missing, a wrong and an outdated quarter, and the three computed again."""
    late, wrong, outdated = "1996Q2", "1997Q3", "1900Q1"
    quarter = F.col("CY_Qtr")
    stale = staffing_summary(
        pbj.where((quarter != late) & ((quarter != wrong) | (F.col("Hrs_CNA") > 0))).union(
            pbj.where(quarter == wrong).withColumn("CY_Qtr", F.lit(outdated))
        )
    )
    fresh = staffing_summary(pbj.where(quarter.isin(late, wrong, outdated)))
    return _iso_dates(with_quarters_replaced(stale, fresh, [late, wrong, outdated]))


def _summary_rows_added(pbj: DataFrame) -> DataFrame:
    """The summary of a part of the days, and that of the others added to it."""
    first = F.col("l_linestatus") == "F"
    return _iso_dates(with_rows_added(staffing_summary(pbj.where(first)), staffing_summary(pbj.where(~first))))


def _infinite_ratios(pbj: DataFrame, provider: DataFrame) -> DataFrame:
    """Hours per resident where some facilities have next to no residents, so that the quotient has no finite value."""
    residents = F.when(F.col("certified_beds") % 10 == 3, F.lit(1e-320)).otherwise(F.col("average_residents_per_day"))
    found = staffing.facility_analysis(pbj, provider.withColumn("average_residents_per_day", residents))
    return found.select(CCN, "provider_name", "avg_total_nurse_hrs", "nurse_hours_per_resident")


def _work_months(pbj: DataFrame) -> DataFrame:
    day = parse_workday(pbj)
    return pbj.select(
        "WorkDate", day.cast("string").alias("work_day"), month_label(day).alias("month")
    )


def _staffing_rows(pbj: DataFrame, provider: DataFrame) -> DataFrame:
    selected = of_selected(pbj, OF_OWNER.full_scope(provider))
    return selected.select(CCN, "provider_name", "state", "WorkDate", "Total_Nurse_Hrs")


def _state_names(provider: DataFrame) -> DataFrame:
    return with_state_name(provider.select(CCN, "provider_name", "state"))


def _facility_text(provider: DataFrame) -> DataFrame:
    residents = F.col("average_residents_per_day")
    return provider.select(
        CCN,
        "provider_name",
        textfmt.percent(F.col("occupancy_rate"), 1).alias("percent_1"),
        textfmt.percent(F.col("occupancy_rate"), 2).alias("percent_2"),
        textfmt.fixed(residents, 1).alias("fixed_1"),
        textfmt.grouped(residents * 1000, 0).alias("grouped_0"),
        textfmt.grouped(residents * 1000, 1).alias("grouped_1"),
        textfmt.grouped(residents * 1000, 2).alias("grouped_2"),
        textfmt.or_not_available(textfmt.ratio_to_one(F.col("occupancy_rate"))).alias("ratio"),
        textfmt.or_not_available(textfmt.percent(F.col("occupancy_rate"))).alias(
            "percent_or_na"
        ),
        textfmt.stars(F.col("overall_rating")).alias("overall_stars"),
        textfmt.stars(F.col("staffing_rating")).alias("staffing_stars"),
    )


def _scope_query(scope: Callable[[DataFrame], DataFrame]) -> Query:
    return _over(
        PROVIDER_INFO,
        lambda df: scope(df).select(
            CCN, "provider_name", "state", "ownership_type", "occupancy_rate"
        ),
    )


def _occupancy_kpis(choice: FacilityFilter) -> Query:
    return _over(
        PROVIDER_INFO,
        lambda df: _rounded(
            occupancy.occupancy_kpis(df, choice),
            "avg_occupancy", "avg_certified_beds", "avg_residents",
        ),
    )


def _staffing_kpis(choice: FacilityFilter) -> Query:
    return _over_both(
        lambda pbj, provider: _rounded(
            staffing.staffing_kpis(pbj, provider, choice),
            "avg_nurse_hours", "avg_nurse_hours_per_resident", "avg_occupancy",
        )
    )


def _hours_per_resident(choice: FacilityFilter) -> Query:
    return _over_both(
        lambda pbj, provider: _rounded(
            staffing.hours_per_resident_by_state(
                staffing.facility_analysis(pbj, provider, choice)
            ),
            "nurse_hours_per_resident",
        )
    )


ANY = FacilityFilter()


def queries() -> dict[str, Query]:
    more = {}
    if llm_queries is not None:
        more = {**llm_queries.queries(), "pipeline": corpus_pipeline.run}
    return {**facility_queries(), **more}


def facility_queries() -> dict[str, Query]:
    return {
        # sources, sinks, audits
        "csv_roundtrip": _csv_roundtrip,
        "parquet_overwrite_roundtrip": _parquet_roundtrip,
        "parquet_partitioned_roundtrip": _partitioned_roundtrip,
        "incremental_curation": _incremental_curation,
        "csv_quarantine": _csv_quarantine,
        "lost_values_audit": _lost_values_audit,
        "row_count_audit": lambda spark, sf_dir: row_count(table(spark, sf_dir, "lineitem")),
        "schema_audit": _audit_query(PROVIDER_INFO),
        "undated_rows": _over(PBJ, undated_rows),
        # renames, dedup
        "rename_pbj": _rename_query(PBJ),
        "rename_provider_info": _rename_query(PROVIDER_INFO),
        "rename_quality": _rename_query(QUALITY),
        "rename_state_averages": _rename_query(STATE_AVERAGES),
        "dedup_full_row": _dedup_full_row,
        # derived columns
        "nurse_hours_strict": _over(
            PBJ,
            lambda df: df.select(
                CCN, "WorkDate", "Total_Nurse_Hrs", "RN_Percentage", "Total_emp_Nurse_Hrs",
                "Emp_Nurse_Percentage", "employee_hrs", "contractor_hrs",
            ),
        ),
        "occupancy_rate": _over(
            PROVIDER_INFO, lambda df: df.select(CCN, "provider_name", "occupancy_rate")
        ),
        "quarterly_scores": _over(
            QUALITY,
            lambda df: df.select(
                CCN, "measure_code", "missing_quarter_count",
                "sum_of_available_quarterly_scores", "max_quarterly_measure_score",
                "min_quarterly_measure_score", "quarterly_score_range",
            ),
        ),
        "deficiency_cycles": _over(
            STATE_AVERAGES,
            lambda df: df.select(
                "state", "all_cycle_total_health_deficiencies",
                "total_health_deficiencies_range",
            ),
        ),
        "work_months": _over(PBJ, _work_months),
        "state_name_lookup": _over(PROVIDER_INFO, _state_names),
        "facility_text": _over(PROVIDER_INFO, _facility_text),
        # curation jobs
        "curate_pbj": _curate_query(PBJ),
        "curate_provider_info": _curate_query(PROVIDER_INFO),
        "curate_quality": _curate_query(QUALITY),
        "curate_state_averages": _curate_query(STATE_AVERAGES),
        # options and scopes
        "filter_options_state": _over(PROVIDER_INFO, state_options),
        "filter_options_owner": _over(PROVIDER_INFO, owner_options),
        "filter_options_owner_in_state": _over(
            PROVIDER_INFO, lambda df: owner_options(df, STATE)
        ),
        "filter_options_provider": _over(
            PROVIDER_INFO, lambda df: provider_options(df, STATE, OWNER)
        ),
        "filter_options_provider_all": _over(PROVIDER_INFO, provider_options),
        "full_scope": _scope_query(FacilityFilter(owner=OWNER, provider=PROVIDER).full_scope),
        "chart_scope": _scope_query(FacilityFilter(owner=OWNER, provider=PROVIDER).chart_scope),
        # occupancy reports
        "occupancy_kpis": _occupancy_kpis(ANY),
        "occupancy_kpis_in_state": _occupancy_kpis(IN_STATE),
        "occupancy_kpis_empty": _occupancy_kpis(NOTHING),
        "occupancy_kpi_text": _over(
            PROVIDER_INFO,
            lambda df: occupancy.occupancy_kpi_text(occupancy.occupancy_kpis(df)),
        ),
        "provider_detail_occupancy": _over(PROVIDER_INFO, occupancy.provider_detail),
        "provider_detail_occupancy_in_state": _over(
            PROVIDER_INFO, lambda df: occupancy.provider_detail(df, IN_STATE)
        ),
        "occupancy_by_provider": _over(
            PROVIDER_INFO,
            lambda df: _rounded(occupancy.occupancy_by_provider(df), "occupancy_rate"),
        ),
        "beds_by_provider": _over(
            PROVIDER_INFO, lambda df: _rounded(occupancy.beds_by_provider(df), "certified_beds")
        ),
        "providers_by_state": _over(PROVIDER_INFO, occupancy.providers_by_state),
        "occupancy_ranking": _over(PROVIDER_INFO, occupancy.occupancy_ranking),
        "facility_analysis_occupancy": _over_both(occupancy.facility_analysis),
        # staffing reports
        "staffing_semi_join": _over_both(_staffing_rows),
        "facility_staffing_3key": _over_both(
            lambda pbj, provider: facility_staffing(pbj, provider, FACILITY_STATE)
        ),
        "facility_staffing_2key": _over_both(
            lambda pbj, provider: facility_staffing(pbj, provider, FACILITY)
        ),
        "facility_staffing_of_owner": _over_both(
            lambda pbj, provider: facility_staffing(
                pbj, OF_OWNER.full_scope(provider), FACILITY
            )
        ),
        "facility_analysis_staffing": _over_both(staffing.facility_analysis),
        "facility_analysis_staffing_of_owner": _over_both(
            lambda pbj, provider: staffing.facility_analysis(pbj, provider, OF_OWNER)
        ),
        "infinite_ratios": _over_both(_infinite_ratios),
        "staffing_kpis": _staffing_kpis(ANY),
        "staffing_kpis_of_owner": _staffing_kpis(OF_OWNER),
        "staffing_kpis_empty": _staffing_kpis(NOTHING),
        "staffing_kpi_text": _over_both(
            lambda pbj, provider: staffing.staffing_kpi_text(
                staffing.staffing_kpis(pbj, provider)
            )
        ),
        "staffing_mix": _over_both(
            lambda pbj, provider: _underscored(staffing.staffing_mix(pbj, provider))
        ),
        "provider_detail_staffing": _over_both(staffing.provider_detail),
        "hours_per_resident_by_state": _hours_per_resident(ANY),
        # roll-ups of the whole staffing table
        "staffing_summary": _over(PBJ, lambda df: _iso_dates(staffing_summary(df))),
        "summary_quarters_replaced": _over(PBJ, _summary_quarters_replaced),
        "summary_rows_added": _over(PBJ, _summary_rows_added),
        "all_rollups": _over(PBJ, rollups.all_rollups),
        "monthly_hours": _over(PBJ, rollups.monthly_hours),
        "hours_by_month": _over(PBJ, rollups.hours_by_month),
        "hours_by_state": _over(PBJ, rollups.hours_by_state),
        "hours_by_provider": _over(PBJ, rollups.hours_by_provider),
        "record_completeness": _over(PBJ, rollups.record_completeness),
        "record_completeness_extra_column": _over(
            PBJ,
            lambda df: rollups.record_completeness(df.withColumn("record_count", F.lit(91))),
        ),
        "unexpected_records": _over(
            PBJ, lambda df: rollups.unexpected_records(rollups.record_completeness(df), 30)
        ),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Hours per resident of each facility, over the smallest test tables."""
    return staffing.facility_analysis(
        curated(spark, SMOKE_DIR, PBJ), curated(spark, SMOKE_DIR, PROVIDER_INFO)
    )


def oracle_sql() -> dict[str, str]:
    more = llm_queries.oracle_sql() if llm_queries is not None else {}
    return {**oracle.statements(STATE, OWNER, PROVIDER), **more}
