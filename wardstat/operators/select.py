"""Row selection used by the serving layer: filters, top-N, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions.measures import in_band
from wardstat.functions.names import col_of

ALL = None  # "all states" / "all hospitals": no filter


def band(df: DataFrame, c, low: float, high: float) -> DataFrame:
    """Rows with ``low < c < high`` (NULL and NaN dropped)."""
    return df.filter(in_band(c, low, high))


def equals(df: DataFrame, c, value) -> DataFrame:
    """Rows where ``c == value``; ``value=None`` means no filter (All)."""
    if value is None:
        return df
    return df.filter(col_of(c) == F.lit(value))


def one_of(df: DataFrame, c, values: Sequence | DataFrame | None) -> DataFrame:
    """Rows whose ``c`` is in ``values``; an empty or absent selection keeps
    every row.

    ``values`` may be a DataFrame of names (one column); it is applied as a
    left-semi join, so a long selection never travels through the driver.
    """
    if values is None:
        return df
    if isinstance(values, DataFrame):
        name = values.columns[0]
        sel = values.select(col_of(name).alias("__sel"))  # a semi join ignores duplicates
        return df.join(sel, col_of(c) == F.col("__sel"), "left_semi")
    values = list(values)
    if not values:
        return df
    return df.filter(col_of(c).isin(values))


def top_n(df: DataFrame, n: int, by, tie_break: Sequence | str = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by``, missing values (NULL, NaN)
    never returned; ties go to the smaller ``tie_break`` value.  Planned as
    a per-task top-N merged in one small final step
    (``TakeOrderedAndProject``), never a full sort."""
    if isinstance(tie_break, (str, Column)):
        tie_break = [tie_break]
    by_c = col_of(by)
    order = [by_c.desc()] + [col_of(t).asc() for t in tie_break]
    # Spark orders NaN above every number, so it is dropped explicitly
    return df.filter(by_c.isNotNull() & ~F.isnan(by_c)).orderBy(*order).limit(n)


def first_rows(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """A stable preview: the first ``n`` rows under a total ``order``."""
    return df.orderBy(*[col_of(o) for o in order]).limit(n)


def distinct_values(df: DataFrame, c, alias: str | None = None, drop_null: bool = True) -> DataFrame:
    """Distinct values of one column (NULL dropped by default), unordered."""
    x = col_of(c)
    out = df.select(x.alias(alias) if alias else x)
    if drop_null:
        out = out.na.drop()
    return out.distinct()


def sorted_distinct(df: DataFrame, c, alias: str | None = None, drop_null: bool = True) -> DataFrame:
    """Distinct values of one column in ascending order (a selector's
    options); the sort runs on the de-duplicated values only."""
    out = distinct_values(df, c, alias, drop_null)
    return out.orderBy(out.columns[0])


def first_names(df: DataFrame, c, n: int = 5) -> DataFrame:
    """The ``n`` smallest distinct values of ``c``, the default selection."""
    out = distinct_values(df, c)
    return out.orderBy(out.columns[0]).limit(n)


def present(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Rows where every column in ``cols`` is non-NULL."""
    if isinstance(cols, str):
        cols = [cols]
    cond = None
    for c in cols:
        x = col_of(c).isNotNull()
        cond = x if cond is None else (cond & x)
    return df.filter(cond)
