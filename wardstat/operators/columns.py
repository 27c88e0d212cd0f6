"""Whole-frame column operators: trim every string column, rewrite headers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wardstat.functions.names import col_of, normalized_headers


def trim_all(df: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    """Trim every string column (or the ones in ``only``) in one projection.

    Non-string columns pass through untouched, so numbers keep their type.
    """
    wanted = None if only is None else {n.lower() for n in only}
    exprs = []
    for f in df.schema.fields:
        c = col_of(f.name)
        if isinstance(f.dataType, StringType) and (wanted is None or f.name.lower() in wanted):
            c = F.trim(c)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def normalize_headers(
    df: DataFrame,
    rules: str | Sequence[tuple[str, str]] = "basic",
    trim: bool = True,
) -> DataFrame:
    """Rename every column by the header rules, trimming strings on the way.

    One ``select`` does both, so the plan has a single Project however wide
    the file is.  Two headers that normalise to the same name raise.
    """
    names = normalized_headers(df.columns, rules)
    exprs = []
    for f, new in zip(df.schema.fields, names):
        c = col_of(f.name)
        if trim and isinstance(f.dataType, StringType):
            c = F.trim(c)
        exprs.append(c.alias(new))
    return df.select(*exprs)


def with_columns(df: DataFrame, cols: dict) -> DataFrame:
    """Replace or add columns in one projection (order kept, new ones last)."""
    lower = {k.lower(): (k, v) for k, v in cols.items()}
    exprs, used = [], set()
    for name in df.columns:
        hit = lower.get(name.lower())
        if hit is None:
            exprs.append(col_of(name))
        else:
            exprs.append(hit[1].alias(name))
            used.add(name.lower())
    for key, (name, c) in lower.items():
        if key not in used:
            exprs.append(c.alias(name))
    return df.select(*exprs)
