"""Silver checks: row count, schema, preview and rule counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wardstat.operators.quality import quality_counts
from wardstat.operators.select import first_rows

# --- fixed values: the staffing table's preview columns and rules --------------
PREVIEW_COLUMNS = (
    "PROVNUM", "STATE", "WorkDate", "TotalNursing_Hours",
    "TotalAdminNursing_Hours", "RN_Ratio", "CNA_Ratio", "LPN_Ratio",
)
PREVIEW_ROWS = 5000
# -------------------------------------------------------------------------------


def staffing_checks(silver: DataFrame) -> DataFrame:
    """(check_name, n): rows, NULL PROVNUM, untrimmed/missing STATE,
    duplicate (PROVNUM, WorkDate) beyond the first, and WorkDate values that
    did not parse (NULL after the silver job)."""
    return quality_counts(
        silver, not_null=["PROVNUM"], unique=["PROVNUM", "WorkDate"], trimmed=["STATE"],
        missing={"unparsed_work_date": "WorkDate"},
    )


def transaction_checks(
    silver: DataFrame, key: str = "CMS_Certification_Number_CCN", stamp: str = "silver_ingested_at",
    extra_key: tuple[str, ...] = (),
) -> DataFrame:
    """(check_name, n) for an appended silver table: rows, NULL keys, and a
    key repeated within one load (same stamp) beyond the first, which the
    latest-record pick then has to break by its tie-break.  ``extra_key``
    adds columns that make a row unique (e.g. the measure code)."""
    return quality_counts(silver, not_null=[key], unique=[key, stamp, *extra_key])


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types (metadata only; no job runs)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def preview(
    df: DataFrame,
    columns: Sequence[str] = PREVIEW_COLUMNS,
    n: int = PREVIEW_ROWS,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """First ``n`` rows of the chosen columns under a stable order."""
    cols = list(columns)
    return first_rows(df.select(*cols), n, list(order) if order else cols)
