"""Command line jobs for spark-submit.

    jobs.py refine  --csv PATH --refined ROOT
    jobs.py curate  DATASET --refined ROOT --curated ROOT [--partition-by COLUMN] [--changed-only]
    jobs.py summary --curated ROOT --out ROOT [--quarter Q ...]
    jobs.py reports --curated ROOT --out ROOT [--state S] [--owner O] [--provider P]

``refine`` keeps the text of rows it cannot read in full below ``_quarantine``; ``curate`` leaves counts of values that are no number below
``_audit`` and, with ``--partition-by``, the list of its input files below ``_manifest``; ``--changed-only`` then
reads only partitions whose files are new, changed or gone.  ``summary`` keeps the staffing summary by quarter and
computes the named quarters again.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from facilitymetrics.operators.reshape import missing_sources
from facilitymetrics.operators.select import (
    EVERYTHING,
    FacilityFilter,
    owner_options,
    provider_options,
    state_options,
)
from facilitymetrics.plans import occupancy, rollups, staffing
from facilitymetrics.plans.curate import curate_clustered, refine_state_averages
from facilitymetrics.plans.facility_staffing import facility_staffing
from facilitymetrics.plans.summary import FACILITY, FACILITY_STATE, Summary, staffing_summary
from facilitymetrics.schemas import (
    DATASETS,
    PBJ,
    PROVIDER_INFO,
    REFINED,
    RENAMES,
    STATE_AVERAGES,
)
from facilitymetrics.session import build_session
from facilitymetrics.sources import manifest
from facilitymetrics.sources.audit import TypeBoundary, schema_findings, undated_rows
from facilitymetrics.sources.lake import (
    Lake,
    read_curated,
    read_parquet,
    read_refined,
    scratch_dir,
    write_parquet,
)
from facilitymetrics.sources.quarantine import read_checked
from facilitymetrics.sources.sizing import sized_tasks

log = logging.getLogger("facilitymetrics")


def refine(spark: SparkSession, csv_path: str, lake: Lake) -> int:
    """Raw CSV of state averages to the refined layer; returns the rows written.

    The CSV is parsed once.  Rows that cannot be read in full go to ``_quarantine`` below the refined root.
    """
    staging = scratch_dir(spark, "staging")
    try:
        checked = read_checked(spark, csv_path, staging, REFINED[STATE_AVERAGES])
        if checked.n_broken:
            log.warning("%s: %d rows could not be read in full", csv_path, checked.n_broken)
        write_parquet(checked.broken, lake.quarantine_path(STATE_AVERAGES))
        with sized_tasks(spark, checked.good):
            return write_parquet(refine_state_averages(checked.good), lake.refined_path(STATE_AVERAGES))
    finally:
        drop_folder(spark, staging)


def drop_folder(spark: SparkSession, path: str) -> None:
    files, where = manifest.file_system(spark, path)
    files.delete(where, True)


def curate_dataset(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    partition_by: Sequence[str] = (),
    touched_partitions_only: bool = False,
    strict: bool = False,
    changed_only: bool = False,
) -> int:
    """Refined to curated for one dataset; returns the rows written.

    With ``changed_only`` and a refined table in directories by ``partition_by`` only the partitions are read whose files
    changed since the last run, and only their curated partitions are replaced or dropped.  ``partition_by`` names
    are the curated ones; the refined directories may have the name from before the rename.
    """
    refined = read_refined(spark, lake, dataset)
    if missing := missing_sources(refined, RENAMES[dataset]):
        log.warning("%s: columns to rename are missing: %s", dataset, missing)
    for finding in schema_findings(refined, REFINED[dataset]):
        log.info("%s: %s", dataset, finding)
    source = {new: old for old, new in RENAMES[dataset].items()}
    columns = [c if c in refined.columns else source.get(c, c) for c in partition_by]
    found = None
    if columns:
        found = manifest.changes(
            spark, lake.refined_path(dataset), lake.manifest_path(dataset), columns, changed_only
        )
        refined = read_refined(spark, lake, dataset)  # files that came after the list was made are read twice, not missed
    out = lake.curated_path(dataset)
    if found is not None and not found.everything:
        for values in found.gone:
            manifest.drop_partition(spark, out, partition_by, values)
        if not found.touched:
            manifest.record(found, lake.manifest_path(dataset))
            return 0
        refined = refined.where(manifest.in_partitions(refined, columns, found.touched))
        touched_partitions_only = True
    boundary = TypeBoundary(REFINED[dataset])
    with sized_tasks(spark, refined):
        curated, clustered = curate_clustered(refined, dataset, partition_by, strict, boundary.watched)
        rows = write_parquet(curated, out, partition_by, touched_partitions_only, clustered)
    write_parquet(boundary.table(refined, rows), lake.audit_path(dataset))
    if found is not None:
        manifest.record(found, lake.manifest_path(dataset))
    return rows


def update_summary(
    spark: SparkSession, lake: Lake, out_root: str, quarters: Sequence[str | None] | None = None
) -> int:
    """The staffing summary in directories by quarter; with ``quarters`` only those are read and replaced.

    A named quarter without staffing rows is dropped.  Returns the rows written.
    """
    pbj = read_curated(spark, lake, PBJ)
    path = f"{out_root.rstrip('/')}/staffing_summary_by_quarter"
    if quarters is not None:
        pbj = pbj.where(manifest.in_partitions(pbj, ["CY_Qtr"], [(q,) for q in quarters]))
        here = {row[0] for row in pbj.select("CY_Qtr").distinct().collect()}  # at most the named ones
        for quarter in set(quarters) - here:
            manifest.drop_partition(spark, path, ["CY_Qtr"], [quarter])
    with sized_tasks(spark, pbj):
        return write_parquet(staffing_summary(pbj), path, ["CY_Qtr"], quarters is not None)


def build_reports(
    spark: SparkSession, lake: Lake, out_root: str, choice: FacilityFilter = EVERYTHING
) -> dict[str, int]:
    """Write every report table below ``out_root``; returns the rows written per table.

    Tables that others are computed from (staffing summary, facility analysis, indicators)
    are written first and read back, so the staffing table is scanned once and a lost
    executor costs at most the table being written.
    """
    pbj = read_curated(spark, lake, PBJ)
    provider = read_curated(spark, lake, PROVIDER_INFO)
    with sized_tasks(spark, pbj, provider):
        return _written_reports(pbj, provider, out_root, choice)


def _written_reports(
    pbj: DataFrame, provider: DataFrame, out_root: str, choice: FacilityFilter
) -> dict[str, int]:
    spark = pbj.sparkSession
    rows: dict[str, int] = {}

    def write(name: str, table: DataFrame) -> DataFrame:
        path = f"{out_root.rstrip('/')}/{name}"
        rows[name] = write_parquet(table, path)
        return read_parquet(spark, path)

    summary = Summary(write("staffing_summary", staffing_summary(pbj)))
    # Monthly figures leave out what this counts.
    write("undated_rows", undated_rows(pbj))
    # One scan of the summary for the four roll-ups.
    rolled = write("rollups", rollups.all_rollups(summary))
    write("monthly_hours", rollups.rollup_of(rolled, "facility"))
    for level in ("month", "state", "provider"):
        write(f"hours_by_{level}", rollups.rollup_of(rolled, level))
    records = write("record_completeness", rollups.record_completeness(summary))
    write("unexpected_records", rollups.unexpected_records(records))

    write("options_state", state_options(provider))
    write("options_owner", owner_options(provider))
    write("options_owner_in_state", owner_options(provider, choice.state))
    write("options_provider", provider_options(provider, choice.state, choice.owner))

    kpis = write("occupancy_kpis", occupancy.occupancy_kpis(provider, choice))
    write("occupancy_kpi_text", occupancy.occupancy_kpi_text(kpis))
    write("occupancy_provider_detail", occupancy.provider_detail(provider, choice))
    write("occupancy_by_provider", occupancy.occupancy_by_provider(provider, choice))
    write("beds_by_provider", occupancy.beds_by_provider(provider, choice))
    write("providers_by_state", occupancy.providers_by_state(provider, choice))
    write("occupancy_ranking", occupancy.occupancy_ranking(provider, choice))
    write(
        "facility_staffing",
        facility_staffing(summary, choice.full_scope(provider), FACILITY_STATE),
    )
    write(
        "facility_staffing_by_name",
        facility_staffing(summary, choice.full_scope(provider), FACILITY),
    )
    write(
        "occupancy_facility_analysis",
        occupancy.facility_analysis(summary, provider, choice),
    )

    analysis = write(
        "staffing_facility_analysis",
        staffing.facility_analysis(summary, provider, choice),
    )
    write("hours_per_resident_by_state", staffing.hours_per_resident_by_state(analysis))
    kpis = write("staffing_kpis", staffing.staffing_kpis(summary, provider, choice))
    write("staffing_kpi_text", staffing.staffing_kpi_text(kpis))
    write("staffing_mix", staffing.labelled_hours(kpis))
    write(
        "staffing_provider_detail", staffing.provider_detail(summary, provider, choice)
    )
    return rows


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="facilitymetrics")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("refine")
    job.add_argument("--csv", required=True)
    job.add_argument("--refined", required=True)

    job = jobs.add_parser("curate")
    job.add_argument("dataset", choices=DATASETS)
    job.add_argument("--refined", required=True)
    job.add_argument("--curated", required=True)
    job.add_argument("--partition-by", action="append", default=[])
    job.add_argument("--touched-partitions-only", action="store_true")
    job.add_argument("--strict", action="store_true")
    job.add_argument("--changed-only", action="store_true")

    job = jobs.add_parser("summary")
    job.add_argument("--curated", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--quarter", action="append")

    job = jobs.add_parser("reports")
    job.add_argument("--curated", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--state")
    job.add_argument("--owner")
    job.add_argument("--provider")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = _arguments(argv)
    spark = build_session()
    lake = Lake(getattr(args, "refined", ""), getattr(args, "curated", ""))
    if args.job == "refine":
        log.info("rows written: %d", refine(spark, args.csv, lake))
    elif args.job == "curate":
        written = curate_dataset(
            spark, lake, args.dataset, args.partition_by, args.touched_partitions_only,
            args.strict, args.changed_only,
        )
        log.info("rows written: %d", written)
    elif args.job == "summary":
        log.info("rows written: %d", update_summary(spark, lake, args.out, args.quarter))
    else:
        choice = FacilityFilter(args.state, args.owner, args.provider)
        for name, written in build_reports(spark, lake, args.out, choice).items():
            log.info("%s: rows written: %d", name, written)


if __name__ == "__main__":
    main()
