"""Column builders for the facility measures.

Row-level: null-safe totals and ratios that never fail on a zero divisor.
Aggregate-level: a Pearson correlation that returns NULL (not an error)
for a zero-variance group, and the least-squares line of y on x.  All
aggregates are algebraic (sums / counts / co-moments), so Spark computes
them with a partial aggregate before the shuffle: a hot group is reduced
map-side and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardstat.functions.names import col_of


def null_safe_sum(cols: Sequence, zero: float = 0.0) -> Column:
    """``coalesce(a,0) + coalesce(b,0) + ...``: missing parts count as 0."""
    parts = [F.coalesce(col_of(c), F.lit(zero)) for c in cols]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def guarded_ratio(numerator, denominator, otherwise: float = 0.0) -> Column:
    """``numerator / denominator`` when the denominator is > 0, else a constant.

    A NULL or non-positive denominator gives ``otherwise``; a NULL numerator
    with a positive denominator stays NULL.
    """
    d = col_of(denominator)
    return F.when(d > 0, col_of(numerator) / d).otherwise(F.lit(otherwise))


def safe_ratio(numerator, denominator) -> Column:
    """``numerator / denominator``; NULL when the denominator is 0 or NULL."""
    return F.try_divide(col_of(numerator), col_of(denominator))


def percent(numerator, denominator) -> Column:
    """``numerator / denominator * 100``; NULL on a 0 or NULL denominator."""
    return safe_ratio(numerator, denominator) * F.lit(100)


def in_band(c, low: float, high: float) -> Column:
    """Open interval ``low < c < high``.

    NULL falls outside; so does NaN, which Spark orders above every number.
    Both bounds are plain comparisons, so they reach the parquet scan as
    pushed filters when ``c`` is a stored column.
    """
    x = col_of(c)
    return (x > F.lit(low)) & (x < F.lit(high))


def _pairs(x, y, missing: str):
    x, y = col_of(x), col_of(y)
    if missing == "zero":
        y = F.coalesce(y, F.lit(0.0))
    elif missing != "drop":
        raise ValueError("missing must be 'zero' or 'drop'")
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def safe_corr(x, y, missing: str = "drop") -> Column:
    """Pearson correlation as an aggregate column.

    ``missing="zero"`` counts a missing y as 0.0 (what the gold job stores);
    ``missing="drop"`` skips pairs with either side missing.  A group whose
    x or y has zero variance gives NULL instead of a division error.
    """
    px, py = _pairs(x, y, missing)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def linear_fit(y, x) -> dict[str, Column]:
    """Least-squares line of ``y`` on ``x`` as aggregate columns.

    Returns ``n``, ``slope``, ``intercept`` and ``r2``; pairs with a NULL
    side are skipped.  A constant x gives NULL slope and intercept.
    """
    y, x = col_of(y), col_of(x)
    return {
        "n": F.regr_count(y, x),
        "slope": F.regr_slope(y, x),
        "intercept": F.regr_intercept(y, x),
        "r2": F.regr_r2(y, x),
    }
