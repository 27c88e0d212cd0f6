"""Column types of text tables, from one aggregate pass over the text.

Spark's own inference reads the files a second time and turns a key such as
``015009`` into a number.  Here every column of an all-text frame is counted
in one job: how many of its values have the form of each type and fit into it.
The type is then the lowest one in this order that all values have:

    void < int < bigint < double < string
    void < boolean < string
    void < date < timestamp < string

A number with a leading zero (``015009``, ``-07``) is text, since the zero
would be lost; so is one that a double cannot hold.  Blank values are missing
values of any type and never decide it.  A column without any value is text.

The counts are sums of 0 and 1, so the pass is a map-side combined aggregate
of one row per task, whatever the number of rows.  Typing is a projection with
``try_cast`` and needs no job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions.names import col_of

# --- fixed values: the forms of typed text ----------------------------------------
WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
NUMBER = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]*)?([eE][+-]?[0-9]{1,3})?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"
FLAG = r"^(?i:true|false)$"
# ----------------------------------------------------------------------------------

#: the chains of types, each from the narrowest on
CHAINS = (("int", "bigint", "double"), ("boolean",), ("date", "timestamp"))
TYPES = tuple(t for chain in CHAINS for t in chain)
TEXT = "string"


def _value(column: str) -> Column:
    """The trimmed text; NULL where it is blank."""
    return F.nullif(F.trim(col_of(column)), F.lit(""))


def typed_value(value: Column, kind: str) -> Column:
    """The text as a value of the type, NULL where it has not its form."""
    if kind == TEXT:
        return value
    if kind in ("int", "bigint"):
        return F.when(value.rlike(WHOLE), value.try_cast(kind))
    if kind == "double":
        number = value.try_cast("double")
        return F.when(value.rlike(NUMBER) & (F.abs(number) < F.lit(float("inf"))), number)
    if kind == "boolean":
        return F.when(value.rlike(FLAG), F.lower(value) == F.lit("true"))
    if kind == "date":
        return F.when(value.rlike(DAY), value.try_cast("date"))
    if kind == "timestamp":
        return F.when(value.rlike(INSTANT), value.try_cast("timestamp_ntz"))
    raise ValueError(f"unknown type {kind!r}")


def type_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: its name, rows with a value, and for each type
    the values that it can hold, all from one aggregate.

    An empty frame has its columns with counts of 0."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        raise ValueError("a frame without columns has no types")
    sums = []
    for i, c in enumerate(columns):
        value = _value(c)
        sums.append(F.count(value).alias(f"n{i}"))
        sums += [F.count(typed_value(value, t)).alias(f"{t}{i}") for t in TYPES]
    one = df.agg(*sums)
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_values"), *[F.col(f"{t}{i}").alias(f"n_{t}") for t in TYPES])
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*rows)))


def chosen_type() -> Column:
    """The type of a row of ``type_counts``."""
    out = F.when(F.col("n_values") == 0, F.lit(TEXT))
    for t in TYPES:
        out = out.when(F.col(f"n_{t}") == F.col("n_values"), F.lit(t))
    return out.otherwise(F.lit(TEXT))


def inferred_types(df: DataFrame, columns: Sequence[str] | None = None, keep_text: Sequence[str] = ()) -> dict[str, str]:
    """Type by column, from one job.  ``keep_text`` names columns that stay
    text whatever they hold (keys, codes)."""
    kept = {c.lower() for c in keep_text}
    columns = [c for c in (df.columns if columns is None else columns) if c.lower() not in kept]
    found = {}
    if columns:
        found = {r["column"]: r["type"] for r in type_counts(df, columns).select("column", chosen_type().alias("type")).collect()}
    return {c: found.get(c, TEXT) for c in df.columns if c in found or c.lower() in kept}


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The frame with the named columns as values of the types.  Blank text
    becomes NULL in a typed column and stays as it is in a text column."""
    own = {c.lower(): t for c, t in types.items()}
    unknown = sorted(set(own) - {c.lower() for c in df.columns})
    if unknown:
        raise ValueError(f"no columns {unknown}")
    out = []
    for c in df.columns:
        kind = own.get(c.lower(), TEXT)
        out.append(col_of(c) if kind == TEXT else typed_value(_value(c), kind).alias(c))
    return df.select(*out)


def infer(df: DataFrame, keep_text: Sequence[str] = ()) -> DataFrame:
    """An all-text frame with every column as the lowest type that holds it."""
    return with_types(df, inferred_types(df, keep_text=keep_text))
