"""Silver -> gold composites.

Column names default to the ones the silver tables carry; every one is a
parameter so the same plans run over other tables of the same shape.

Scale notes
-----------
- Every aggregate here is algebraic (sum, count, avg, co-moments, regr_*),
  so Spark pre-aggregates map-side before the shuffle: a state or facility
  holding a third of the rows is reduced inside each map task.
- The latest-record picks shuffle once on the facility key; the join that
  follows is on the same key, so the planner reuses that partitioning
  instead of shuffling again (or broadcasts when a side is measured small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.functions.cleaning import to_number, to_number_or
from wardstat.functions.measures import in_band, null_safe_sum, percent, safe_corr, safe_ratio
from wardstat.functions.names import col_of
from wardstat.operators.columns import with_columns
from wardstat.operators.dedup import latest_per_key
from wardstat.operators.joins import join_keep_left

CCN = "CMS_Certification_Number_CCN"
STAMP = "silver_ingested_at"

# --- fixed values: gold column names and the discharge-to-community measure ---
HOURS_RNDON = "Hrs_RNDON"
TOTAL_RN_HOURS = "Total_RN_Hours"
TOTAL_NURSE_RATIO = "Total_Nurse_Ratio"
RESIDENTS = "Average_Number_of_Residents_per_Day"
BEDS = "Number_of_Certified_Beds"
BED_RATE = "Bed_Utilization_Rate"
SCORE = "Score"
THROUGHPUT = "Patient_Throughput"
THROUGHPUT_MEASURE = "S_005_02_DTC_VOLUME"
STAFF_HOURS = "Reported_Total_Nurse_Staffing_Hours_per_Resident_per_Day"
READMISSION = "Performance_Period_FY_2022_Risk_Standardized_Readmission_Rate"
CORRELATION = "Correlation_Coefficient"
STAFF_BAND = (1.0, 15.0)
# ------------------------------------------------------------------------------


def _latest(df: DataFrame, key, stamp: str | None, tie_break) -> DataFrame:
    """Latest record per key, or the frame as is when it has a single load
    (``stamp=None``)."""
    if stamp is None:
        return df
    return latest_per_key(df, key, stamp=stamp, tie_break=tie_break)


# --- staffing ------------------------------------------------------------------


def onduty_hours(
    silver: DataFrame,
    by: Sequence[str] = ("STATE", "WorkDate"),
    hours: str = HOURS_RNDON,
    name: str = TOTAL_RN_HOURS,
) -> DataFrame:
    """Director-of-nursing hours summed per state and day."""
    return silver.groupBy(*[col_of(b) for b in by]).agg(F.sum(col_of(hours)).alias(name))


def nurse_ratio_column(total: str = "TotalNursing_Hours", census: str = "MDScensus"):
    """Total nursing hours per resident; NULL when census is 0 or NULL."""
    return safe_ratio(null_safe_sum([total]), census)


def nurse_ratio(
    silver: DataFrame,
    by: Sequence[str],
    name: str,
    total: str = "TotalNursing_Hours",
    census: str = "MDScensus",
) -> DataFrame:
    """Mean nurse-to-patient ratio per group (hospital, state or the
    (RN_Ratio, CNA_Ratio) pair the reports call "department")."""
    ratio = nurse_ratio_column(total, census)
    return silver.groupBy(*[col_of(b) for b in by]).agg(F.avg(ratio).alias(name))


# --- bed utilisation -------------------------------------------------------------


def bed_utilization(
    provider: DataFrame,
    mds: DataFrame,
    by: Sequence[str],
    name: str,
    key: str = CCN,
    residents: str = RESIDENTS,
    beds: str = BEDS,
    mds_keep: Sequence[str] | None = None,
    stamp: str | None = STAMP,
    tie_break=None,
    digits: int = 2,
    enrich=None,
    pre_aggregate: bool | None = None,
    hot=None,
) -> DataFrame:
    """Mean bed utilisation percent per group, rounded.

    The provider side is reduced to its latest load first (every appended
    load would otherwise be counted again).  Each MDS row of a facility
    counts once, so per-resident-type means are weighted by MDS rows; a
    facility with zero or missing beds contributes NULL and is skipped.
    ``enrich`` (joined frame -> frame) attaches lookup columns, e.g. a state
    name from a dimension, after the fact-sized join and before grouping.

    Where residents and beds are provider columns the MDS rows are first
    reduced to a row count per facility and MDS grouping key, so the join
    shuffles counts instead of every MDS row (also of a facility that has
    very many); the mean is then weighted by those counts (equal up to
    floating-point rounding).  ``pre_aggregate`` forces or forbids that; where
    it is not done, ``hot="auto"`` spreads facilities with very many MDS rows
    (see ``join_keep_left``).
    """
    prov = _latest(provider, key, stamp, tie_break)
    if pre_aggregate is None:
        pre_aggregate = mds_keep is None and on_provider(prov, residents, beds)
    if pre_aggregate:
        return _bed_utilization_weighted(prov, mds, by, name, key, residents, beds, digits, enrich)
    joined = join_keep_left(prov, mds, key, keep=mds_keep, hot=hot)
    if enrich is not None:
        joined = enrich(joined)
    rate = percent(residents, beds)
    return joined.groupBy(*[col_of(b) for b in by]).agg(F.round(F.avg(rate), digits).alias(name))


ROWS = "__rows"


def on_provider(prov: DataFrame, *columns: str) -> bool:
    """Whether all the columns are the provider's."""
    return {c.lower() for c in columns} <= {c.lower() for c in prov.columns}


def mds_counts(prov: DataFrame, mds: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """MDS rows counted per facility and the grouping columns that only MDS has."""
    prov_cols, mds_cols = ({c.lower() for c in df.columns} for df in (prov, mds))
    own = [b for b in dict.fromkeys(by) if b.lower() in mds_cols and b.lower() not in prov_cols]
    return mds.groupBy(col_of(key).alias(key), *[col_of(b) for b in own]).agg(F.count(F.lit(1)).alias(ROWS))


def _bed_utilization_weighted(prov, mds, by, name, key, residents, beds, digits, enrich):
    if not on_provider(prov, residents, beds):
        raise ValueError("pre_aggregate needs residents and beds on the provider side")
    joined = join_keep_left(prov, mds_counts(prov, mds, key, by), key)
    if enrich is not None:
        joined = enrich(joined)
    rate = percent(residents, beds)
    rows = F.col(ROWS)
    mean = F.try_divide(F.sum(rate * rows), F.sum(F.when(rate.isNotNull(), rows)))
    return joined.groupBy(*[col_of(b) for b in by]).agg(F.round(mean, digits).alias(name))


# --- patient throughput -------------------------------------------------------


def patient_throughput(
    provider: DataFrame,
    skilled: DataFrame,
    key: str = CCN,
    measure: str | None = THROUGHPUT_MEASURE,
    measure_col: str = "Measure_Code",
    score: str = SCORE,
    beds: str = BEDS,
    skilled_keep: Sequence[str] | None = None,
    provider_stamp: str | None = STAMP,
    skilled_stamp: str | None = STAMP,
    provider_tie_break=None,
    skilled_tie_break=None,
    name: str = THROUGHPUT,
    digits: int = 2,
) -> DataFrame:
    """Discharges to community per certified bed, one row per facility.

    The measure filter runs before the latest-record pick (the pick is
    "latest row of this measure"), and is pushed to the scan.  Beds and
    score default to 0.0; a facility with 0 beds gets a NULL throughput.
    """
    prov = _latest(provider, key, provider_stamp, provider_tie_break)
    prov = with_columns(prov, {beds: to_number_or(beds, 0.0)})
    sk = skilled if measure is None else skilled.filter(col_of(measure_col) == F.lit(measure))
    sk = _latest(sk, key, skilled_stamp, skilled_tie_break)
    sk = with_columns(sk, {score: to_number_or(score, 0.0)})
    joined = join_keep_left(prov, sk, key, keep=skilled_keep)
    return joined.withColumn(name, F.round(safe_ratio(score, beds), digits))


# --- staffing x readmission -----------------------------------------------------


def staffing_readmission(
    provider: DataFrame,
    facility: DataFrame,
    key: str = CCN,
    hours: str = STAFF_HOURS,
    rate: str = READMISSION,
    band: tuple[float, float] = STAFF_BAND,
    missing: str = "zero",
    facility_keep: Sequence[str] | None = None,
    stamp: str | None = STAMP,
    tie_break=None,
    count_name: str | None = None,
    hot=None,
    null_safe: bool = False,
    skewed: str = "right",
) -> tuple[DataFrame, DataFrame]:
    """Detail rows in the staffing band and the one-row correlation summary.

    ``missing="zero"`` stores a missing readmission rate as 0.0 and lets it
    into the correlation (what the gold table holds); ``missing="drop"``
    keeps it NULL, and the correlation skips that pair (the cross-check).
    ``stamp=None`` skips the latest-record pick (the cross-check joins all
    loads); there ``hot`` spreads a facility with very many rows on the
    ``skewed`` side, and ``null_safe`` joins rows without a key with each
    other (see ``join_keep_left``).  Staffing hours missing or unparsable count as 0.0, which falls
    outside any band with a non-negative lower bound; so the band is tested
    on the parsed value before the fill, where it can reach the scan.
    """
    low, high = band
    prov = _latest(provider, key, stamp, tie_break)
    fac = _latest(facility, key, stamp, tie_break)
    joined = join_keep_left(prov, fac, key, keep=facility_keep, hot=hot, null_safe=null_safe, skewed=skewed)
    if low >= 0:
        detail = joined.filter(in_band(to_number(hours), low, high))
        filled = {hours: to_number(hours)}
    else:
        filled = {hours: to_number_or(hours, 0.0)}
    filled[rate] = to_number_or(rate, 0.0) if missing == "zero" else to_number(rate)
    detail = with_columns(detail if low >= 0 else joined, filled)
    if low < 0:
        detail = detail.filter(in_band(hours, low, high))
    aggs = [safe_corr(hours, rate, missing="drop").alias(CORRELATION)]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    summary = detail.agg(*aggs)
    return detail, summary
