"""Gold jobs that write several outputs from one pass.

The per-output functions in ``gold`` are what a report reads.  These jobs
are what a scheduler runs, written for the case where the inputs are large:

- ``staffing_rollups``: the hours table and the hospital and state ratio
  tables have few groups and share one scan and one ``GROUPING SETS``
  aggregate (partial aggregation per grouping set in the map task, one
  shuffle).  The "department" table groups by two continuous ratios, nearly
  one group per row, which no partial aggregation reduces; it is a second
  aggregate of its own, so it does not fill the small sets' hash map.  Both
  are written once as a table partitioned by ``summary``.
- ``bed_utilization_rollups``: the by-hospital and by-resident-type tables
  share the provider x MDS join; same technique, one join.
- ``staffing_readmission_tables``: the detail table is written first and the
  one-row summary is computed from the written table, so the summary never
  re-runs the latest-record picks and the join (and a lost executor after
  the detail write costs nothing upstream).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.functions.measures import percent, safe_corr
from wardstat.functions.names import col_of
from wardstat.operators.joins import join_keep_left
from wardstat.plans import gold
from wardstat.sources.files import read_table
from wardstat.sources.sinks import overwrite

SUMMARY = "summary"

# --- fixed values: output names of the staffing gold tables -------------------------
STAFFING_SETS = {
    "onduty_hours_summary": ("STATE", "WorkDate"),
    "ratio_by_hospital": ("PROVNUM", "PROVNAME"),
    "ratio_by_state": ("STATE",),
    "ratio_by_department": ("RN_Ratio", "CNA_Ratio"),
}
NEAR_UNIQUE_SETS = ("ratio_by_department",)
BED_SETS = {
    "utilization_by_hospital": ("Provider_Name", "State"),
    "utilization_by_department": ("Resident_type",),
}
# Measure names of each table as the report pages read them.
STAFFING_TABLE_MEASURES = {
    "onduty_hours_summary": {"Total_RN_Hours": "Total_RN_Hours"},
    "ratio_by_hospital": {"Avg_Nurse_Ratio": "Avg_Nurse_Ratio_ByHospital"},
    "ratio_by_state": {"Avg_Nurse_Ratio": "Avg_Nurse_Ratio_ByState"},
    "ratio_by_department": {"Avg_Nurse_Ratio": "Avg_Nurse_Ratio_ByDepartment"},
}
BED_TABLE_MEASURES = {
    "utilization_by_hospital": {"Bed_Utilization": "Bed_Utilization_By_Hospital"},
    "utilization_by_department": {"Bed_Utilization": "Bed_Utilization_By_Department"},
}
# ------------------------------------------------------------------------------------


def _grouping_sets(df: DataFrame, sets: dict[str, Sequence[str]], inputs: dict, outputs: dict) -> DataFrame:
    """One aggregate over several grouping sets, tagged with the set's name.

    Each input row is expanded once per set inside the map task and
    pre-aggregated there, so the shuffle carries at most one row per group
    per task and the input is scanned once.  ``inputs`` are row-level
    columns computed before the expansion; ``outputs`` map output names to
    functions building the aggregate from those columns.
    """
    cols: list[str] = []
    for keys in sets.values():
        for k in keys:
            if k not in cols:
                cols.append(k)
    base = df.select(*[col_of(c) for c in cols], *[c.alias(n) for n, c in inputs.items()])
    # grouping_id(): bit set for every column *not* in the set, first column highest
    tag = None
    for set_name, keys in sets.items():
        gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys)
        cond = F.grouping_id(*[col_of(c) for c in cols]) == F.lit(gid)
        tag = F.when(cond, F.lit(set_name)) if tag is None else tag.when(cond, F.lit(set_name))
    grouped = base.groupingSets([[col_of(k) for k in keys] for keys in sets.values()], *[col_of(c) for c in cols])
    aggs = [build(F.col(f"`{src}`")).alias(name) for name, (src, build) in outputs.items()]
    out = grouped.agg(*aggs, tag.alias("__tag"))
    return out.select(F.col("__tag").alias(SUMMARY), *[col_of(c) for c in cols], *[F.col(f"`{n}`") for n in outputs])


def staffing_rollups(
    silver: DataFrame,
    hours: str = gold.HOURS_RNDON,
    total: str = "TotalNursing_Hours",
    census: str = "MDScensus",
    sets: dict[str, Sequence[str]] = STAFFING_SETS,
) -> DataFrame:
    """All staffing gold tables as one frame with a ``summary`` column:
    ``Total_RN_Hours`` (sum of director-of-nursing hours) and
    ``Avg_Nurse_Ratio`` (mean total-hours-per-resident) per grouping set."""
    inputs = {"__hours": col_of(hours), "__ratio": gold.nurse_ratio_column(total, census)}
    outputs = {gold.TOTAL_RN_HOURS: ("__hours", F.sum), "Avg_Nurse_Ratio": ("__ratio", F.avg)}
    wide = {n: keys for n, keys in sets.items() if n in NEAR_UNIQUE_SETS}
    small = {n: keys for n, keys in sets.items() if n not in wide}
    out = _grouping_sets(silver, small, inputs, outputs) if small else None
    for name, keys in wide.items():
        aggs = [build(inputs[src]).alias(n) for n, (src, build) in outputs.items()]
        part = silver.groupBy(*[col_of(k) for k in keys]).agg(*aggs).withColumn(SUMMARY, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    # a measure that a summary does not define is NULL there
    defined = [n for n in sets if gold.TOTAL_RN_HOURS in STAFFING_TABLE_MEASURES.get(n, {gold.TOTAL_RN_HOURS: ""})]
    with_hours = F.when(F.col(SUMMARY).isin(defined), F.col(gold.TOTAL_RN_HOURS))
    ratio_sets = [n for n in sets if "Avg_Nurse_Ratio" in STAFFING_TABLE_MEASURES.get(n, {"Avg_Nurse_Ratio": ""})]
    with_ratio = F.when(F.col(SUMMARY).isin(ratio_sets), F.col("Avg_Nurse_Ratio"))
    return out.withColumns({gold.TOTAL_RN_HOURS: with_hours, "Avg_Nurse_Ratio": with_ratio})


def bed_utilization_rollups(
    provider: DataFrame,
    mds: DataFrame,
    key: str = gold.CCN,
    residents: str = gold.RESIDENTS,
    beds: str = gold.BEDS,
    stamp: str | None = gold.STAMP,
    tie_break=None,
    sets: dict[str, Sequence[str]] = BED_SETS,
    digits: int = 2,
    enrich=None,
) -> DataFrame:
    """Both bed-utilisation tables from one provider x MDS join
    (``enrich`` as in ``gold.bed_utilization``).

    Where residents and beds are provider columns (the job's tables), the MDS
    rows are first reduced to counts per facility and MDS grouping column:
    the join then carries one row per facility and resident type, and a
    facility with very many MDS rows is reduced inside the map tasks."""
    prov = gold._latest(provider, key, stamp, tie_break)
    counted = gold.on_provider(prov, residents, beds)
    if counted:
        keys = [k for names in sets.values() for k in names]
        mds = gold.mds_counts(prov, mds, key, keys)
    joined = join_keep_left(prov, mds, key)
    if enrich is not None:
        joined = enrich(joined)
    rate = percent(residents, beds)
    if counted:
        inputs = {"__sum": rate * F.col(gold.ROWS), "__n": F.when(rate.isNotNull(), F.col(gold.ROWS))}
        outputs = {"__total": ("__sum", F.sum), "__count": ("__n", F.sum)}
        out = _grouping_sets(joined, sets, inputs, outputs)
        mean = F.round(F.try_divide("__total", "__count"), digits)
        return out.withColumn("Bed_Utilization", mean).drop("__total", "__count")
    outputs = {"Bed_Utilization": ("__rate", lambda c: F.round(F.avg(c), digits))}
    return _grouping_sets(joined, sets, {"__rate": rate}, outputs)


def summary_part(rollups: DataFrame, name: str, sets: dict[str, Sequence[str]]) -> DataFrame:
    """One summary table out of a rollup frame or its written table."""
    keys = list(sets[name])
    measures = [c for c in rollups.columns if c not in {SUMMARY} and c not in _all_keys(sets)]
    return rollups.filter(F.col(SUMMARY) == F.lit(name)).select(*[col_of(k) for k in keys], *[col_of(m) for m in measures])


def _all_keys(sets) -> set[str]:
    return {k for keys in sets.values() for k in keys}


def write_rollups(rollups: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a rollup frame once, one partition per summary table."""
    overwrite(rollups, path, fmt=fmt, partition_by=[SUMMARY])


def staffing_readmission_tables(
    spark: SparkSession,
    provider: DataFrame,
    facility: DataFrame,
    detail_path: str,
    summary_path: str,
    fmt: str = "parquet",
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Write the detail table, then the correlation summary computed from it.

    ``options`` are those of ``gold.staffing_readmission``.  Returns the two
    written tables read back.
    """
    detail, _ = gold.staffing_readmission(provider, facility, **options)
    overwrite(detail, detail_path, fmt=fmt)
    stored = read_table(spark, detail_path, fmt)
    hours = options.get("hours", gold.STAFF_HOURS)
    rate = options.get("rate", gold.READMISSION)
    summary = stored.agg(safe_corr(hours, rate, missing="drop").alias(gold.CORRELATION))
    overwrite(summary, summary_path, fmt=fmt, single_file=True)
    return stored, read_table(spark, summary_path, fmt)


def write_summary_tables(
    spark: SparkSession,
    rollup_path: str,
    root: str,
    sets: dict[str, Sequence[str]],
    measures: dict[str, dict[str, str]],
    fmt: str = "parquet",
) -> dict[str, str]:
    """Fan a written rollup out into one table per summary, named and
    shaped as the report pages read them (``root/<summary name>``).

    Each table reads only its own partition of the rollup, so the source
    data is still scanned once in total.
    """
    stored = read_table(spark, rollup_path, fmt)
    written = {}
    for name, keys in sets.items():
        part = stored.filter(F.col(SUMMARY) == F.lit(name))
        cols = [col_of(k) for k in keys] + [col_of(src).alias(dst) for src, dst in measures[name].items()]
        path = f"{root.rstrip('/')}/{name}"
        overwrite(part.select(*cols), path, fmt=fmt)
        written[name] = path
    return written
