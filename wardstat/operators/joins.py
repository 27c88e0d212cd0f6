"""Joins that keep one copy of each column.

The reference joins two tables that share many column names and then drops
the right side's copies.  Here the right side is narrowed to the key plus
the wanted columns *before* the join: no ambiguity, and the scan of the
right table reads only those columns.

No broadcast hint is set.  Spark broadcasts a side only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` (statically from
file sizes, and again by AQE from the real shuffle size); above it the
join stays a sort-merge join.  AQE splits its skewed partitions where both
sides come straight from a shuffle; after a latest-record pick (a window) it
does not.  For those joins hot keys are found and spread here:

* ``hot_keys`` finds them with a mergeable frequent-items sketch of the keys'
  hashes: one pass over the key columns, a bounded sketch per task, nothing
  shuffled but the sketches;
* rows of a hot key are dealt over buckets by a hash of the whole row, the
  other side's rows of that key are copied once per bucket, and all other rows
  are joined as they are.  It is one join; only the hot keys' rows are copied.

NULL keys never match in a plain join.  ``null_safe`` makes them match each
other, and spreads their rows like those of a hot key, so that they do not all
meet in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions.names import col_of


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


HOT_SHARE = 0.005  # of all rows, from which on a key is hot
TRACKED = 10_000  # keys that a sketch keeps; it errs by 3.5 / TRACKED of the rows at most


def key_hash(on: Sequence[str]) -> Column:
    """One value for the key columns, NULLs included.  Keys that share it by
    chance are spread together, which changes no result."""
    return F.xxhash64(*[col_of(k) for k in on])


def hot_keys(df: DataFrame, on: str | Sequence[str], share: float = HOT_SHARE) -> dict[int, float]:
    """Hashes of the keys that hold ``share`` of the rows or more, with their
    shares.  A key slightly below may be among them, none above is missing;
    there are never more than 2 / ``share``."""
    most = 2 * math.ceil(1 / share)
    sketch = F.call_function("approx_top_k", key_hash(_as_list(on)), F.lit(most), F.lit(TRACKED))
    one = df.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {t["item"]: t["count"] / one.n for t in one.top or () if t["count"] >= (share - 3.5 / TRACKED) * one.n}


def join_keep_left(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    keep: Sequence[str] | None = None,
    how: str = "inner",
    salt_buckets: int | None = None,
    skewed: str = "right",
    hot: Mapping[int, float] | str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join on shared key column(s); from ``right`` keep only ``keep``.

    ``keep=None`` keeps every right column whose name the left side does not
    already have.  Asking to keep a name the left side has is an error.

    ``hot`` spreads the keys in which the ``skewed`` side is hot: the result of
    ``hot_keys``, or ``"auto"`` to find them now (a pass over its keys).  The
    rows of one key are dealt by a hash of the whole row, so rows that are
    equal in every column stay together: give the side a column that tells
    them apart, or count them first.  ``salt_buckets`` spreads every key over
    that many buckets instead.

    ``null_safe`` joins NULL keys with each other.  The rows are every left
    row with a NULL key with every right one that has the same NULLs.

    Spreading needs an inner join, or a left join whose left side is skewed.
    """
    on = _as_list(on)
    on_l = {k.lower() for k in on}
    left_names = {c.lower() for c in left.columns}
    if keep is None:
        keep = [c for c in right.columns if c.lower() not in left_names]
    clash = [c for c in keep if c.lower() in left_names and c.lower() not in on_l]
    if clash:
        raise ValueError(f"columns {clash} exist on both sides; rename one first")
    right_cols = on + [c for c in keep if c.lower() not in on_l]
    right = right.select(*[col_of(c) for c in right_cols])
    if skewed not in ("left", "right"):
        raise ValueError("skewed must be 'left' or 'right'")
    if hot == "auto":
        hot = hot_keys(left if skewed == "left" else right, on)
    every = bool(salt_buckets and salt_buckets > 1)
    if not every and not hot and not null_safe:
        return left.join(right, on=on, how=how)
    if how != "inner" and not (how == "left" and skewed == "left"):
        raise ValueError("rows can be spread in an inner join, or in a left join whose left side is skewed")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = salt_buckets if every else spread_buckets(hot or {}, parts, null_safe)
    spread = F.lit(True) if every else _to_spread(on, hot or {}, null_safe)
    if skewed == "right":
        right, left = _salted(right, buckets, spread), _replicated(left, buckets, spread)
    else:
        left, right = _salted(left, buckets, spread), _replicated(right, buckets, spread)
    if not null_safe:
        return left.join(right, on=on + [_SALT], how=how).drop(_SALT)
    own = {k: f"__right_{i}" for i, k in enumerate([*on, _SALT])}
    right = right.withColumnsRenamed(own)
    same = reduce(lambda a, b: a & b, [col_of(k).eqNullSafe(col_of(r)) for k, r in own.items() if k != _SALT])
    return left.join(right, same & (col_of(_SALT) == col_of(own[_SALT])), how).drop(_SALT, *own.values())


def spread_buckets(hot: Mapping[int, float], partitions: int, nulls: bool = False) -> int:
    """Buckets that bring a bucket of the hottest key down to a quarter of a
    partition's share, so that a few that meet in one partition do not stand
    out; for NULL keys, whose share is not known, at least 16."""
    return max(2, math.ceil(4 * max(hot.values(), default=0.0) * partitions), 16 if nulls else 0)


def _to_spread(on: list[str], hot: Mapping[int, float], nulls: bool) -> Column:
    """Whether a row's key is one of those that are spread."""
    out = F.lit(False)
    if hot:
        out = key_hash(on).isin([int(h) for h in hot])
    if nulls:
        out = reduce(lambda a, b: a | b, [col_of(k).isNull() for k in on], out)
    return out


_SALT = "__salt"


def _salted(df: DataFrame, buckets: int, spread: Column) -> DataFrame:
    """A bucket per row that is to be spread, from a hash of the whole row:
    deterministic, so a retried task puts every row in the same bucket again
    (a random salt would make the shuffle indeterminate on retry); bucket 0
    for the others.  Exact duplicate rows share a bucket."""
    row_hash = F.xxhash64(*[col_of(c) for c in df.columns])
    return df.withColumn(_SALT, F.when(spread, F.pmod(row_hash, F.lit(buckets)).cast("int")).otherwise(F.lit(0)))


def _replicated(df: DataFrame, buckets: int, spread: Column) -> DataFrame:
    """One copy per bucket of every row that meets spread rows."""
    last = F.when(spread, F.lit(buckets - 1)).otherwise(F.lit(0))
    return df.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last)))
