"""Column builders for cleaning text coming out of CSV files.

All of them are plain Catalyst expressions (codegen-friendly, no Python per
row) and are safe under ANSI mode: bad text becomes NULL instead of failing
the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardstat.functions.names import col_of


def clean_text(c) -> Column:
    """Strip leading/trailing spaces (same rule as SQL ``trim``)."""
    return F.trim(col_of(c))


def clean_code(c) -> Column:
    """Trimmed, upper-case code such as a state abbreviation."""
    return F.upper(F.trim(col_of(c)))


def blank_as_null(c) -> Column:
    """NULL for values that are empty after trimming."""
    t = F.trim(col_of(c))
    return F.when(t == F.lit(""), F.lit(None)).otherwise(t)


def to_number(c, dtype: str = "double") -> Column:
    """Text -> number; unparsable text becomes NULL (``try_cast``)."""
    return col_of(c).try_cast(dtype)


def to_number_or(c, default: float = 0.0, dtype: str = "double") -> Column:
    """Text -> number with a default for NULL or unparsable values."""
    return F.coalesce(to_number(c, dtype), F.lit(default).cast(dtype))


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date by pattern; text that does not match becomes NULL."""
    return F.try_to_date(col_of(c), fmt)


def load_stamp() -> Column:
    """Load time of the current query (one value for the whole query)."""
    return F.current_timestamp()
