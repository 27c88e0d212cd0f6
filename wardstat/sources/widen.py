"""Types of a stored column over the batches of a table.

A batch may bring a column with another type than the batches before it.  The
column's type is then the lowest one that holds all of them:

    tinyint < smallint < int < bigint < decimal < double      float < double
    date < timestamp, date < timestamp_ntz
    anything atomic but binary < string

(bigint and double meet in double, which rounds whole numbers beyond 2^53.)
Types that do not meet there (a boolean and a number, a number and a date, a
struct and anything else) are refused before anything is written.

Files keep the type they were written with.  Each type of a column is stored
under a name of its own, the first one under the column's name, a later one
under ``name__type``; a field's metadata says which column it belongs to.  So
one scan with one schema reads every batch, a file never has to be rewritten,
and the column is the first of its stored forms that is not NULL, cast to the
common type.  Filters on columns of a single type reach the scan as before.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from wardstat.functions.names import col_of

OF = "column"  # metadata key: the column that a stored field belongs to
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


class TypeConflict(ValueError):
    """Two batches bring a column with types that have no common one."""


def _same(a: DataType, b: DataType) -> bool:
    return a.simpleString() == b.simpleString()


def _is(t: DataType, *kinds: type) -> bool:
    return isinstance(t, kinds)


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The lowest type that holds both; None if there is none."""
    if _same(a, b):
        return a
    if _is(a, NullType) or _is(b, NullType):
        return b if _is(a, NullType) else a
    numbers = (*_WHOLE, DecimalType, FloatType, DoubleType)
    if _is(a, *_WHOLE) and _is(b, *_WHOLE):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if _is(a, *numbers) and _is(b, *numbers):
        if _is(a, FloatType, DoubleType) or _is(b, FloatType, DoubleType):
            return DoubleType()
        sizes = [(t.precision - t.scale, t.scale) if _is(t, DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        whole, scale = (max(s) for s in zip(*sizes))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    days = (TimestampType, TimestampNTZType)
    if _is(a, DateType) and _is(b, *days):
        return b
    if _is(b, DateType) and _is(a, *days):
        return a
    plain = (*numbers, BooleanType, DateType, *days, StringType)
    if (_is(a, StringType) and _is(b, *plain)) or (_is(b, StringType) and _is(a, *plain)):
        return StringType()
    return None


def column_of(field: StructField) -> str:
    """The column that a stored field belongs to."""
    return (field.metadata or {}).get(OF, field.name)


def forms(stored: StructType) -> dict[str, list[StructField]]:
    """Lower-cased column -> its stored fields, in the order of the columns."""
    out: dict[str, list[StructField]] = {}
    for f in stored.fields:
        out.setdefault(column_of(f).lower(), []).append(f)
    return out


def merged_type(fields: list[StructField]) -> DataType:
    def step(a: DataType, b: DataType) -> DataType:
        found = common_type(a, b)
        if found is None:
            raise TypeConflict(f"column {column_of(fields[0])!r} is {a.simpleString()} and cannot also be {b.simpleString()}")
        return found

    return reduce(step, [f.dataType for f in fields])


def stored_form(batch: StructType, stored: StructType | None) -> tuple[StructType, list[Column]]:
    """(the table's stored fields with the batch's, the batch's columns under
    the names they are stored by).  Raises ``TypeConflict`` where a column's
    types do not meet."""
    known = forms(stored) if stored is not None else {}
    fields = list(stored.fields) if stored is not None else []
    taken = {f.name.lower() for f in fields} | {f.name.lower() for f in batch.fields}
    columns = []
    for f in batch.fields:
        own = known.get(f.name.lower(), [])
        value, kind = col_of(f.name), f.dataType
        if isinstance(kind, NullType):  # a column without a type takes the one it has, or text
            kind = own[0].dataType if own else StringType()
            value = value.cast(kind)
        same = next((o for o in own if _same(o.dataType, kind)), None)
        if same is None:
            name, of = f.name, column_of(own[0]) if own else f.name
            if own:
                merged_type([*own, StructField(of, kind)])
                name = base = f"{of}__{re.sub(r'[^0-9a-z]+', '_', kind.simpleString().lower()).strip('_')}"
                n = 2
                while name.lower() in taken:
                    name, n = f"{base}_{n}", n + 1
            same = StructField(name, kind, True, {OF: of} if own else {})
            taken.add(name.lower())
            fields.append(same)
        columns.append(value.alias(same.name))
    return StructType(fields), columns


def as_columns(rows: DataFrame, stored: StructType) -> DataFrame:
    """The table's columns from rows read with its stored fields."""
    if not any((f.metadata or {}).get(OF) for f in stored.fields):
        return rows
    out = []
    for fields in forms(stored).values():
        name = column_of(fields[0])
        if len(fields) == 1:
            out.append(col_of(fields[0].name).alias(name))
            continue
        kind = merged_type(fields)
        out.append(F.coalesce(*[col_of(f.name).cast(kind) for f in fields]).alias(name))
    return rows.select(*out)
