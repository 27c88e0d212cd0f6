"""Data-quality counts computed in one pass over a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions.names import col_of


# --- fixed values: the characters that count as white space at a value's ends ------
_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
OUTER_SPACE = rf"\A{_SPACE}|{_SPACE}\z"
# ------------------------------------------------------------------------------------


def quality_counts(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    trimmed: Sequence[str] = (),
    row_count: bool = True,
    missing: dict[str, str] | None = None,
) -> DataFrame:
    """Violation counts as rows ``(check_name, n)``.

    - ``row_count``: rows in the table.
    - ``null_key``: rows where any ``not_null`` column is NULL.
    - ``untrimmed``: rows where a ``trimmed`` column is NULL or begins or ends
      with white space of any kind, tabs, line ends and no-break spaces
      included (a missing value counts as a violation).
    - ``duplicate_key``: rows beyond the first per ``unique`` key, NULLs
      comparing equal.
    - one row per ``missing`` entry ``{check name: column}``: rows where that
      column is NULL (e.g. dates that did not parse).

    All checks are aggregates of one scan.  With ``unique`` the rows are
    first counted per key (a map-side partial aggregate, so a hot key is
    reduced before the shuffle and no row is duplicated for a distinct
    count), then the per-key counts are summed.  The caller decides what a
    non-zero count means.
    """
    row_level: dict[str, Column] = {}
    if not_null:
        any_null = None
        for c in not_null:
            cond = col_of(c).isNull()
            any_null = cond if any_null is None else (any_null | cond)
        row_level["null_key"] = any_null
    if trimmed:
        bad = None
        for c in trimmed:
            x = col_of(c)
            cond = x.isNull() | x.rlike(OUTER_SPACE)
            bad = cond if bad is None else (bad | cond)
        row_level["untrimmed"] = bad
    for check, c in (missing or {}).items():
        row_level[check] = col_of(c).isNull()
    if not (row_count or row_level or unique):
        raise ValueError("no check requested")

    if unique:
        per_key = df.groupBy(*[col_of(c) for c in unique]).agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.count_if(cond).alias(name) for name, cond in row_level.items()],
        )
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        aggs = []
        if row_count:
            aggs.append(total(F.col("__rows")).alias("row_count"))
        aggs += [total(F.col(name)).alias(name) for name in row_level]
        aggs.append(total(F.col("__rows") - 1).alias("duplicate_key"))
        wide = per_key.agg(*aggs)
    else:
        aggs = [F.count(F.lit(1)).alias("row_count")] if row_count else []
        aggs += [F.count_if(cond).alias(name) for name, cond in row_level.items()]
        wide = df.agg(*aggs)
    order = ["row_count", "null_key", "untrimmed", "duplicate_key", *list(missing or {})]
    names = [n for n in order if n in wide.columns]
    return wide.unpivot([], names, "check_name", "n")
