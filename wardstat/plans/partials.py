"""Gold rollups that are kept up to date load by load.

Sums and counts merge: the state of a group over all loads is the sum of its
states over each.  So every load of a silver table is reduced once to partial
states, stored as a batch of the same name in a table of partials, and a gold
rollup is a merge of those, many times smaller than the silver rows.  A
refresh reads the loads that are new, or were written after their partials;
the loads that the partials know are not opened.  Partials of a load that has
gone from the silver table are left out of the merge.

This is for silver tables whose loads add up (each row counts once, in its
load).  A table of which only the latest record per facility counts goes
through ``plans.snapshot``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.functions.names import col_of
from wardstat.plans import gold
from wardstat.plans.jobs import STAFFING_SETS, SUMMARY
from wardstat.sources.files import read_table
from wardstat.sources.sinks import BATCH_COL, append_batches, batches_in, stored_schema

SUM, COUNT = "__sum", "__count"


def _keys(sets: Mapping[str, Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(k for names in sets.values() for k in names))


def partial_states(rows: DataFrame, sets: Mapping[str, Sequence[str]], measures: Mapping[str, Column]) -> DataFrame:
    """Per load, summary and group: sum and count of every measure.  Every
    summary is an aggregate of its own, combined on the map side."""
    keys = _keys(sets)
    inputs = rows.select(BATCH_COL, *[col_of(k) for k in keys], *[m.cast("double").alias(n) for n, m in measures.items()])
    states = [s for n in measures for s in (F.sum(n).alias(n + SUM), F.count(n).alias(n + COUNT))]
    out = None
    for name, own in sets.items():
        part = inputs.groupBy(BATCH_COL, *[col_of(k) for k in own]).agg(*states).withColumn(SUMMARY, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(SUMMARY, *[col_of(k) for k in keys], *[n + s for n in measures for s in (SUM, COUNT)], BATCH_COL)


def stale_loads(spark: SparkSession, table: str, partials: str) -> list[str]:
    """Loads without partials, or written when those were or later."""
    there, done = batches_in(spark, table), batches_in(spark, partials)
    return sorted(b for b, at in there.items() if done.get(b, -1) <= at)


def refresh_partials(
    spark: SparkSession,
    table: str,
    partials: str,
    sets: Mapping[str, Sequence[str]],
    measures: Mapping[str, Column],
    fmt: str = "parquet",
) -> list[str]:
    """Bring the partials up to the table's loads; returns the loads read.  A
    run that crashed is repeated: a load's partials replace what it left."""
    loads = stale_loads(spark, table, partials)
    if loads:
        rows = read_table(spark, table, fmt).filter(F.col(BATCH_COL).isin(loads))
        append_batches(partial_states(rows, sets, measures), partials, fmt)
    return loads


def merged(spark: SparkSession, table: str, partials: str, sets: Mapping[str, Sequence[str]], measures: Mapping[str, Column], fmt: str = "parquet") -> DataFrame:
    """(summary, keys, <measure>__sum, <measure>__count) over the table's loads."""
    keys = _keys(sets)
    if stored_schema(spark, partials) is None:
        raise ValueError(f"{partials} holds no partials; refresh them first")
    rows = read_table(spark, partials, fmt).filter(F.col(BATCH_COL).isin(list(batches_in(spark, table))))
    states = [F.sum(n + s).alias(n + s) for n in measures for s in (SUM, COUNT)]
    return rows.groupBy(SUMMARY, *[col_of(k) for k in keys]).agg(*states)


# --- the staffing rollups (G7) ------------------------------------------------------------


def staffing_measures(hours: str = gold.HOURS_RNDON, total: str = "TotalNursing_Hours", census: str = "MDScensus") -> dict[str, Column]:
    return {"hours": col_of(hours), "ratio": gold.nurse_ratio_column(total, census)}


def refresh_staffing(spark: SparkSession, silver: str, partials: str, fmt: str = "parquet", sets: Mapping[str, Sequence[str]] = STAFFING_SETS, **columns: str) -> list[str]:
    return refresh_partials(spark, silver, partials, sets, staffing_measures(**columns), fmt)


def staffing_rollups(spark: SparkSession, silver: str, partials: str, fmt: str = "parquet", sets: Mapping[str, Sequence[str]] = STAFFING_SETS) -> DataFrame:
    """The frame of ``jobs.staffing_rollups``, from the partials."""
    rows = merged(spark, silver, partials, sets, staffing_measures(), fmt)
    hours = F.when(F.col(SUMMARY) == "onduty_hours_summary", F.col("hours" + SUM))
    ratio = F.when(F.col(SUMMARY) != "onduty_hours_summary", F.try_divide("ratio" + SUM, "ratio" + COUNT))
    return rows.select(SUMMARY, *[col_of(k) for k in _keys(sets)], hours.alias(gold.TOTAL_RN_HOURS), ratio.alias("Avg_Nurse_Ratio"))


# --- bed utilisation (G8) -----------------------------------------------------------------


def refresh_mds_counts(spark: SparkSession, mds: str, partials: str, by: Sequence[str], key: str = gold.CCN, fmt: str = "parquet") -> list[str]:
    """MDS rows per facility and the MDS columns ``by``, load by load."""
    return refresh_partials(spark, mds, partials, {"mds": [key, *by]}, {"rows": F.lit(1)}, fmt)


def bed_utilization(
    spark: SparkSession,
    provider: DataFrame,
    mds: str,
    partials: str,
    by: Sequence[str],
    name: str,
    mds_by: Sequence[str] = (),
    key: str = gold.CCN,
    residents: str = gold.RESIDENTS,
    beds: str = gold.BEDS,
    digits: int = 2,
    fmt: str = "parquet",
) -> DataFrame:
    """``gold.bed_utilization`` of the latest provider rows (one per facility,
    e.g. ``snapshot.latest``) and all MDS loads, from their counts."""
    counts = merged(spark, mds, partials, {"mds": [key, *mds_by]}, {"rows": F.lit(1)}, fmt)
    counts = counts.select(col_of(key), *[col_of(b) for b in mds_by], F.col("rows" + COUNT).alias(gold.ROWS))
    joined = provider.join(counts, key)
    rate = gold.percent(residents, beds)
    rows = F.col(gold.ROWS)
    mean = F.try_divide(F.sum(rate * rows), F.sum(F.when(rate.isNotNull(), rows)))
    return joined.groupBy(*[col_of(b) for b in by]).agg(F.round(mean, digits).alias(name))
