"""The latest record per key of a table of loads, kept as a table of its own.

A gold plan that picks the latest record per facility would read every load
ever appended.  The snapshot holds the picked rows and the names of the loads
they were picked from; a refresh reads the snapshot and the loads that came
since, and replaces the snapshot in one step (a version and a pointer, see
``sources.sinks``).  The pick is associative: the latest of (the latest of the
old loads) and (the new loads) is the latest of all, as its order is total.

A load that was written again after it was picked from (a replayed batch), or
that has gone, cannot be taken out of the snapshot, so the next refresh reads
all loads once.  The names are kept in the snapshot's version folder, so a
crash at any step leaves a snapshot that knows what is in it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.operators.dedup import latest_per_key
from wardstat.plans.gold import CCN, STAMP
from wardstat.sources.files import read_table
from wardstat.sources.sinks import BATCH_COL, batches_in, overwrite, read_note

LOADS = "_loads"


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the loads it read, and whether it began anew."""

    loads: tuple[str, ...]
    rebuilt: bool


def known_loads(spark: SparkSession, snapshot: str) -> dict[str, int] | None:
    """The loads in a snapshot with their write times; None without one."""
    text = read_note(spark, snapshot, LOADS)
    return None if text is None else json.loads(text)


def new_rows(spark: SparkSession, table: str, loads: Sequence[str] | None, fmt: str = "parquet") -> DataFrame:
    """The rows of the named loads (all for None); others are not listed."""
    rows = read_table(spark, table, fmt)
    return rows if loads is None else rows.filter(F.col(BATCH_COL).isin(list(loads)))


def refresh_latest(
    spark: SparkSession,
    table: str,
    snapshot: str,
    keys: str | Sequence[str] = CCN,
    stamp: str = STAMP,
    tie_break: Sequence | str | None = None,
    fmt: str = "parquet",
) -> Refresh:
    """Bring the snapshot of ``table`` up to its loads.  The rows keep their
    load's name in ``batch_id``, which also decides between rows that are
    equal in stamp and tie-break."""
    there, known = batches_in(spark, table), known_loads(spark, snapshot)
    rebuilt = known is None or any(there.get(b) != at for b, at in known.items())
    fresh = sorted(there if rebuilt else set(there) - set(known))
    if not fresh and known is not None and not rebuilt:
        return Refresh((), False)
    rows = new_rows(spark, table, None if rebuilt else fresh, fmt)
    if not rebuilt:
        rows = read_table(spark, snapshot, fmt).unionByName(rows, allowMissingColumns=True)
    if tie_break is not None:
        given = [tie_break] if isinstance(tie_break, str) or not isinstance(tie_break, Sequence) else list(tie_break)
        tie_break = [*given, BATCH_COL]
    picked = latest_per_key(rows, keys, stamp=stamp, tie_break=tie_break)
    overwrite(picked, snapshot, fmt=fmt, notes={LOADS: json.dumps(there, sort_keys=True)})
    return Refresh(tuple(fresh), rebuilt)


def latest(spark: SparkSession, snapshot: str, fmt: str = "parquet") -> DataFrame:
    """The latest rows, for the gold plans (with ``stamp=None``)."""
    return read_table(spark, snapshot, fmt).drop(BATCH_COL)
