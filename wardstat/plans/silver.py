"""Raw -> silver composites.

Each takes the raw DataFrame (all-string CSV columns, see
``sources.files.read_csv``) and returns the cleaned one; writing is left to
``sources.sinks`` so the same frame can be appended as a repeatable batch or
overwritten.  Every step is a projection or a filter except the
de-duplication of the staffing file, which shuffles once on its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from wardstat.functions.cleaning import clean_code, clean_text, load_stamp, parse_date, to_number, to_number_or
from wardstat.functions.measures import guarded_ratio, null_safe_sum
from wardstat.functions.names import col_of
from wardstat.operators.columns import normalize_headers, with_columns
from wardstat.operators.dedup import dedup_by_key

CCN = "CMS_Certification_Number_CCN"
STAMP = "silver_ingested_at"

# --- fixed values: staffing-file column names --------------------------------
MASTER_KEY = ("PROVNUM", "WorkDate")
NURSING_HOURS = ("Hrs_RN", "Hrs_LPN", "Hrs_CNA")
ADMIN_HOURS = ("Hrs_Rnadmin", "Hrs_LPNadmin")
CENSUS = "MDScensus"
RATIOS = (("RN_Ratio", "Hrs_RN"), ("CNA_Ratio", "Hrs_CNA"), ("LPN_Ratio", "Hrs_LPN"))
MASTER_NUMERIC = ("Hrs_RNDON", "Hrs_RN", "Hrs_LPN", "Hrs_CNA", "Hrs_Rnadmin", "Hrs_LPNadmin", "MDScensus")
# -----------------------------------------------------------------------------


def master_staffing(
    raw: DataFrame,
    date_format: str = "yyyy-MM-dd",
    order: Sequence | None = None,
    blank_is_null: bool = False,
    dedup_null_dates: bool = True,
    numeric: Sequence[str] = MASTER_NUMERIC,
) -> DataFrame:
    """Daily staffing file -> one row per (PROVNUM, WorkDate) with totals.

    - rows with a NULL PROVNUM are dropped (tested before trimming, so a
      blank key survives unless ``blank_is_null``);
    - PROVNUM trimmed, STATE trimmed and upper-cased, WorkDate parsed
      (unparsable text -> NULL);
    - hours and census read as doubles (bad text -> NULL) instead of
      relying on schema inference, so keys like ``015009`` stay text;
    - one survivor per key, the first under ``order`` (all other columns
      ascending when not given);
    - totals count missing hours as 0; ratios are 0 when census <= 0/NULL.

    ``dedup_null_dates=False`` keeps every row whose date did not parse
    instead of collapsing them into one per facility.
    """
    key = F.col("PROVNUM")
    cond = key.isNotNull()
    if blank_is_null:
        cond = cond & (F.trim(key) != F.lit(""))
    present = {c.lower() for c in raw.columns}
    fixes = {
        "PROVNUM": clean_text("PROVNUM"),
        "STATE": clean_code("STATE"),
        "WorkDate": _work_date(raw, date_format),
    }
    for c in numeric:
        # an hours column the file does not carry is missing for every row
        fixes[c] = to_number(c) if c.lower() in present else F.lit(None).cast("double")
    cleaned = with_columns(raw.filter(cond), fixes)

    if dedup_null_dates:
        deduped = dedup_by_key(cleaned, list(MASTER_KEY), order)
    else:
        dated = cleaned.filter(F.col("WorkDate").isNotNull())
        undated = cleaned.filter(F.col("WorkDate").isNull())
        deduped = dedup_by_key(dated, list(MASTER_KEY), order).unionByName(undated)

    derived = {
        "TotalNursing_Hours": null_safe_sum(NURSING_HOURS),
        "TotalAdminNursing_Hours": null_safe_sum(ADMIN_HOURS),
    }
    for name, hours in RATIOS:
        derived[name] = guarded_ratio(hours, CENSUS)
    return with_columns(deduped, derived)


def undated_rows(raw: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Rows with a key whose WorkDate does not parse (or is missing)."""
    return raw.filter(F.col("PROVNUM").isNotNull() & _work_date(raw, date_format).isNull())


def _work_date(raw: DataFrame, date_format: str):
    """WorkDate as a date: parsed by pattern when it is text, taken as is
    (or truncated) when the source already carries a date or timestamp."""
    field = next((f for f in raw.schema.fields if f.name.lower() == "workdate"), None)
    if field is None:
        raise ValueError("the staffing file has no WorkDate column")
    kind = field.dataType
    if isinstance(kind, DateType):
        return F.col("WorkDate")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.to_date("WorkDate")
    return parse_date("WorkDate", date_format)


def _transaction_table(
    raw: DataFrame,
    rules: str,
    numeric: Sequence[str] = (),
    numeric_default: dict[str, float] | None = None,
    key: str = CCN,
    stamp: bool | str = True,
) -> DataFrame:
    """Shared shape of the five transaction files: trim + rename headers in
    one projection, key as text, typed measures, load stamp.

    ``stamp=True`` stamps the current time (one value per query);
    a timestamp text such as ``"2024-10-01 00:00:00"`` stamps that value, so
    a replayed batch writes exactly the rows of the first attempt;
    ``False`` adds no stamp."""
    df = normalize_headers(raw, rules=rules, trim=True)
    fixes = {key: col_of(key).cast("string")}
    for c in numeric:
        fixes[c] = to_number(c)
    for c, default in (numeric_default or {}).items():
        fixes[c] = to_number_or(c, default)
    if isinstance(stamp, str):
        fixes[STAMP] = F.lit(stamp).cast("timestamp")
    elif stamp:
        fixes[STAMP] = load_stamp()
    return with_columns(df, fixes)


def provider_info(raw: DataFrame, stamp: bool | str = True) -> DataFrame:
    """Provider file: residents per day and certified beds become doubles;
    a missing residents value stays NULL (it must not pull rates down)."""
    return _transaction_table(
        raw,
        "basic",
        numeric=("Average_Number_of_Residents_per_Day", "Number_of_Certified_Beds"),
        stamp=stamp,
    )


def facility_performance(raw: DataFrame, stamp: bool | str = True) -> DataFrame:
    """Facility performance file: readmission rate becomes a double."""
    return _transaction_table(
        raw,
        "extended",
        numeric=("Performance_Period_FY_2022_Risk_Standardized_Readmission_Rate",),
        stamp=stamp,
    )


def quality_claims(raw: DataFrame, stamp: bool | str = True) -> DataFrame:
    """Claims-based quality measures: headers, key and stamp only."""
    return _transaction_table(raw, "basic", stamp=stamp)


def quality_mds(raw: DataFrame, stamp: bool | str = True) -> DataFrame:
    """MDS quality measures: headers, key and stamp only."""
    return _transaction_table(raw, "basic", stamp=stamp)


def skilled_nursing(raw: DataFrame, stamp: bool | str = True) -> DataFrame:
    """Skilled nursing measures: Score becomes a double, bad text -> 0.0."""
    return _transaction_table(raw, "extended", numeric_default={"Score": 0.0}, stamp=stamp)
