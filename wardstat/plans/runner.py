"""Command-line entry for the jobs: ``python -m wardstat JOB [options]``.

Each job reads its inputs, runs one composite and writes its outputs; paths
and formats are arguments (the source jobs hard-code them).

    silver-master     --raw DIR  --out PATH [--date-format P] [--undated keep|collapse|fail]  (G1, overwrite)
    silver-provider   --raw FILE --out PATH --batch ID           (G2, repeatable append)
    silver-facility   ... same                                   (G3)
    silver-claims     ... same                                   (G4)
    silver-mds        ... same                                   (G5)
    silver-skilled    ... same                                   (G6)
    intake            --landing DIR --manifest PATH --out PATH --job-name silver-provider
                      (G13 + S3/S4: that job's changed files, each as a batch of its own;
                      silver-master rebuilds its table from all listed files)
    gold-staffing     --silver PATH --out PATH [--layout tables]  (G7)
    gold-bed          --provider PATH --mds PATH --out PATH [--layout tables]  (G8)
    gold-throughput   --provider PATH --skilled PATH --out PATH  (G9)
    gold-readmission  --provider PATH --facility PATH --out PATH [--missing zero|drop] (G10/G12, detail + summary)
    checks            --silver PATH [--table transaction]        (G11: counts, schema, preview)

Report pages (``--gold PATH``; rows are printed, or written with ``--out PATH``;
a table that does not exist yet gives no rows):

    report-total-hours / report-hours-series                      (C1)
    report-hospitals [--state S] [--names A,B]                    (C2, first five names by default)
    report-ratio-states / report-departments                      (C3, C4)
    report-top-throughput [--n 10]                                (C5)
    report-bed-hospitals [--state S] [--names A,B] / report-bed-departments  (C6)
    report-kpis [--state S] [--summary PATH]                      (C7; r read from the stored summary)
    report-scatter [--state S] / report-trend [--state S]         (C8)
    report-states                                                 (state selector options)
"""

from __future__ import annotations

import argparse
import functools
import json
import os

from wardstat.plans import checks, gold, jobs, serving, silver
from wardstat.session import build_session
from wardstat.sources.files import read_csv, read_or_empty, read_table
from wardstat.sources.intake import JOB_FILES, allow_listed, ingest_changed, list_files, rebuild_if_changed
from wardstat.sources.sinks import append_batch, overwrite

TRANSACTION_JOBS = {
    "silver-provider": silver.provider_info,
    "silver-facility": silver.facility_performance,
    "silver-claims": silver.quality_claims,
    "silver-mds": silver.quality_mds,
    "silver-skilled": silver.skilled_nursing,
}

def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wardstat", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job")
    for opt in ("raw", "out", "landing", "manifest", "silver", "provider", "mds", "skilled", "facility"):
        p.add_argument(f"--{opt}")
    p.add_argument("--batch", default=None,
                   help="batch id of a silver-* append (needed); 'intake' puts it before the ids of its files")
    p.add_argument("--job-name", dest="job_name", default=None, help="silver job run by 'intake'")
    p.add_argument("--names", default=None, help="comma-separated: file names 'intake' takes (default: the job's files), or hospitals of a report")
    p.add_argument("--gold", default=None, help="gold table read by the report-* jobs")
    p.add_argument("--state", default=None, help="report-kpis/report-trend: one state (default all)")
    p.add_argument("--n", type=int, default=10, help="report-top-throughput: how many")
    p.add_argument("--table", choices=["staffing", "transaction"], default="staffing", help="checks: which rules")
    p.add_argument("--stamp", default=None, help="silver-*/intake: fixed load stamp, e.g. '2024-10-01 00:00:00'")
    p.add_argument("--date-format", dest="date_format", default="yyyy-MM-dd", help="pattern of the staffing file's WorkDate")
    p.add_argument("--undated", choices=["keep", "collapse", "fail"], default="keep",
                   help="staffing rows whose date does not parse: all kept, one per facility, or refused")
    p.add_argument("--missing", choices=["zero", "drop"], default="zero", help="gold-readmission: missing rates")
    p.add_argument("--summary", default=None, help="report-kpis: the stored correlation summary")
    p.add_argument("--format", default="parquet")
    p.add_argument("--layout", choices=["rollup", "tables"], default="rollup",
                   help="gold-staffing/gold-bed: one partitioned table, or one table per summary")
    p.add_argument("--master", default=None, help="only for local runs")
    return p


def run(args: list[str] | None = None, spark=None) -> dict:
    """Run one job; returns a small summary (what was written, counts)."""
    a = _parser().parse_args(args)
    spark = spark or build_session(a.master)
    fmt = a.format

    if a.job == "silver-master":
        return _master(a, read_csv(spark, a.raw), fmt)
    stamp = a.stamp or True  # a fixed stamp makes a replayed batch identical
    if a.job in TRANSACTION_JOBS:
        if not a.batch:
            raise SystemExit(f"{a.job} appends: --batch names the load, so that a re-run replaces it and nothing else")
        append_batch(TRANSACTION_JOBS[a.job](read_csv(spark, a.raw), stamp=stamp), a.out, a.batch, fmt=fmt)
        return {"written": a.out, "batch": a.batch}
    if a.job == "intake":
        names = a.names.split(",") if a.names else JOB_FILES[a.job_name]
        listing = allow_listed(list_files(spark, a.landing), names=names)
        if a.job_name == "silver-master":  # the staffing table is rebuilt from all its files
            done: dict = {}
            taken = rebuild_if_changed(spark, listing, a.manifest, lambda raw: done.update(_master(a, raw, fmt)), job=a.job_name)
            return {"files": taken, **done}
        transform = functools.partial(TRANSACTION_JOBS[a.job_name], stamp=stamp)
        taken = ingest_changed(spark, listing, a.manifest, a.out, transform, a.batch, fmt=fmt, job=a.job_name)
        return {"files": taken, "batch": a.batch}
    if a.job in ("gold-staffing", "gold-bed"):
        if a.job == "gold-staffing":
            rollups = jobs.staffing_rollups(read_table(spark, a.silver, fmt))
            sets, measures = jobs.STAFFING_SETS, jobs.STAFFING_TABLE_MEASURES
        else:
            rollups = jobs.bed_utilization_rollups(read_table(spark, a.provider, fmt), read_table(spark, a.mds, fmt))
            sets, measures = jobs.BED_SETS, jobs.BED_TABLE_MEASURES
        if a.layout == "tables":  # one table per summary, as the report pages read them
            rollup_path = os.path.join(a.out, "_rollup")
            jobs.write_rollups(rollups, rollup_path, fmt=fmt)
            return {"written": jobs.write_summary_tables(spark, rollup_path, a.out, sets, measures, fmt)}
        jobs.write_rollups(rollups, a.out, fmt=fmt)
        return {"written": a.out}
    if a.job == "gold-throughput":
        t = gold.patient_throughput(read_table(spark, a.provider, fmt), read_table(spark, a.skilled, fmt))
        overwrite(t, a.out, fmt=fmt)
        return {"written": a.out}
    if a.job == "gold-readmission":
        detail_path = os.path.join(a.out, "facility_metrics")
        summary_path = os.path.join(a.out, "correlation_summary")
        jobs.staffing_readmission_tables(
            spark, read_table(spark, a.provider, fmt), read_table(spark, a.facility, fmt), detail_path, summary_path,
            fmt=fmt, missing=a.missing,
        )
        return {"written": [detail_path, summary_path]}
    if a.job.startswith("report-"):
        frame = _report(spark, a, fmt)
        if a.out:  # any size
            overwrite(frame, a.out, fmt=fmt)
            return {"written": a.out}
        local = serving.collect_bounded(frame, max_rows=10_000)
        return {"rows": local.astype(object).where(local.notna(), None).to_dict(orient="records")}  # NULL -> null, not NaN
    if a.job == "checks":
        table = read_table(spark, a.silver, fmt)
        staffing = a.table == "staffing"
        frame = checks.staffing_checks(table) if staffing else checks.transaction_checks(table)
        shown = [c for c in (checks.PREVIEW_COLUMNS if staffing else table.columns) if c in table.columns]
        head = checks.preview(table, shown, n=a.n).collect()
        return {
            "checks": {r.check_name: r.n for r in frame.collect()},
            "schema": checks.schema_of(table),
            "preview": [r.asDict() for r in head],
        }
    raise SystemExit(f"unknown job {a.job!r}; see --help")


def _master(a, raw, fmt: str) -> dict:
    """Write the staffing table; reports how many dates did not parse."""
    undated = silver.undated_rows(raw, a.date_format).count()
    if undated and a.undated == "fail":
        raise SystemExit(f"{undated} rows have a WorkDate that is not {a.date_format}")
    table = silver.master_staffing(raw, date_format=a.date_format, dedup_null_dates=a.undated == "collapse")
    overwrite(table, a.out, fmt=fmt)
    return {"written": a.out, "undated_rows": undated}


# what a report page shows while its gold table has not been written
_EMPTY = {
    "report-total-hours": f"STATE string, WorkDate date, {gold.TOTAL_RN_HOURS} double",
    "report-hours-series": f"STATE string, WorkDate date, {gold.TOTAL_RN_HOURS} double",
    "report-hospitals": "PROVNUM string, PROVNAME string, Avg_Nurse_Ratio_ByHospital double",
    "report-ratio-states": "STATE string, Avg_Nurse_Ratio_ByState double",
    "report-departments": "RN_Ratio double, CNA_Ratio double, Avg_Nurse_Ratio_ByDepartment double",
    "report-bed-hospitals": "Provider_Name string, State string, Bed_Utilization_By_Hospital double",
    "report-bed-departments": "Resident_type string, Bed_Utilization_By_Department double",
    "report-top-throughput": f"{gold.CCN} string, Provider_Name string, {gold.THROUGHPUT} double, State string",
}
_DETAIL = f"{gold.CCN} string, Provider_Name string, State string, {gold.STAFF_HOURS} double, {gold.READMISSION} double"
# the summary of a rollup table that a page reads, with the measure's name there
_PART = {
    "report-total-hours": ("onduty_hours_summary", jobs.STAFFING_SETS, jobs.STAFFING_TABLE_MEASURES),
    "report-hours-series": ("onduty_hours_summary", jobs.STAFFING_SETS, jobs.STAFFING_TABLE_MEASURES),
    "report-hospitals": ("ratio_by_hospital", jobs.STAFFING_SETS, jobs.STAFFING_TABLE_MEASURES),
    "report-ratio-states": ("ratio_by_state", jobs.STAFFING_SETS, jobs.STAFFING_TABLE_MEASURES),
    "report-departments": ("ratio_by_department", jobs.STAFFING_SETS, jobs.STAFFING_TABLE_MEASURES),
    "report-bed-hospitals": ("utilization_by_hospital", jobs.BED_SETS, jobs.BED_TABLE_MEASURES),
    "report-bed-departments": ("utilization_by_department", jobs.BED_SETS, jobs.BED_TABLE_MEASURES),
}


def _page_table(spark, a, fmt: str):
    """The gold table of a page, whichever layout it was written in."""
    table = read_or_empty(spark, a.gold, _EMPTY.get(a.job, _DETAIL), fmt)
    if a.job in _PART and jobs.SUMMARY in table.columns:
        name, sets, measures = _PART[a.job]
        part = jobs.summary_part(table, name, sets)
        keep = list(sets[name]) + list(measures[name])
        return part.select(*keep).withColumnsRenamed(measures[name])
    return table


def _report(spark, a, fmt: str):
    """The chart-ready rows of one report page."""
    table = _page_table(spark, a, fmt)
    names = a.names.split(",") if a.names else None
    if a.job == "report-total-hours":
        return serving.total_hours(table)
    if a.job == "report-hours-series":
        return serving.hours_series(table)
    if a.job in ("report-ratio-states", "report-departments", "report-bed-departments"):
        return table
    if a.job == "report-hospitals":
        return serving.hospital_bars(table, names, "PROVNAME", None)
    if a.job == "report-bed-hospitals":
        return serving.hospital_bars(table, names, "Provider_Name", a.state)
    if a.job == "report-top-throughput":
        cols = [gold.CCN, "Provider_Name", gold.THROUGHPUT, "State", "City/Town"]
        cols = [c for c in cols if c.lower() in {x.lower() for x in table.columns}]
        return serving.top_throughput(table, a.n, columns=cols)
    if a.job == "report-kpis":
        stored = None
        if a.summary:
            stored = serving.scalar(read_or_empty(spark, a.summary, f"{gold.CORRELATION} double", fmt), gold.CORRELATION)
        return serving.kpi_cards(table, a.state, stored=stored, use_stored=bool(a.summary))
    if a.job == "report-scatter":
        return serving.scatter_points(table, gold.STAFF_HOURS, gold.READMISSION, state=a.state)
    if a.job == "report-trend":
        return serving.trend_line(table, gold.READMISSION, gold.STAFF_HOURS, state=a.state)
    if a.job == "report-states":
        return serving.states(table)
    raise SystemExit(f"unknown report {a.job!r}")


def main(args: list[str] | None = None) -> None:
    print(json.dumps(run(args), default=str))
