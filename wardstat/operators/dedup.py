"""One row per key: latest record and de-duplication.

Both are written as ``row_number() over (partition by key order by ...) = 1``.
Catalyst turns the ``= 1`` filter into a ``WindowGroupLimit`` that runs
*before* the shuffle as well as after it, so every map task forwards at most
one row per key: a key that holds a third of the table costs one row per
map task in the exchange, not a third of the table in one reducer.

The order must be total, otherwise the survivor depends on partitioning
(rows of one load share one ``silver_ingested_at``).  Callers pass a
tie-break; ``dedup_by_key`` falls back to all remaining columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from wardstat.functions.names import col_of

_RN = "__rn"


def _key_cols(keys) -> list[Column]:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    return [col_of(k) for k in keys]


def _order_cols(order) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [col_of(o) for o in order]


def first_per_key(df: DataFrame, keys, order: Sequence) -> DataFrame:
    """Keep the first row of each key under ``order`` (a list of Columns,
    e.g. ``F.col("ts").desc()``)."""
    w = Window.partitionBy(*_key_cols(keys)).orderBy(*_order_cols(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_per_key(
    df: DataFrame,
    keys,
    stamp: str = "silver_ingested_at",
    tie_break: Sequence | str | None = None,
) -> DataFrame:
    """Latest record per key by ``stamp`` (descending, NULL stamps last).

    ``tie_break`` orders rows that share a stamp (descending as well unless
    Columns with their own direction are given).  Without it the remaining
    orderable columns are used so the survivor is still reproducible.
    """
    if tie_break is None:
        key_names = _key_names(keys)
        tie_break = [
            n for n in _orderable(df) if n.lower() not in key_names and n.lower() != stamp.lower()
        ]
    elif isinstance(tie_break, (str, Column)):
        tie_break = [tie_break]
    order = [col_of(stamp).desc_nulls_last()] + [
        t if isinstance(t, Column) else col_of(t).desc_nulls_last() for t in tie_break
    ]
    return first_per_key(df, keys, order)


def dedup_by_key(df: DataFrame, keys, order: Sequence | None = None) -> DataFrame:
    """One row per key; the survivor is the first under ``order`` (ascending
    over all other columns when not given), never an arbitrary one."""
    if order is None:
        key_names = _key_names(keys)
        order = [n for n in _orderable(df) if n.lower() not in key_names]
    return first_per_key(df, keys, order)


def _key_names(keys) -> set[str]:
    """Lower-cased names of the key columns given by name."""
    if isinstance(keys, (str, Column)):
        keys = [keys]
    return {k.lower() for k in keys if isinstance(k, str)}


def _orderable(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, (MapType, ArrayType, StructType))
    ]
