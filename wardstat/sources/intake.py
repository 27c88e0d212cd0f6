"""Changed-file intake: which raw files are new or rewritten since the last run.

State is a *manifest* table ``(job, path, seen modified-time)`` written by
the previous runs.  A file is taken when its modified time is later than
the one recorded for it, or when it has no record yet (first run: the
floor time below).

Every taken file is a batch of its own, whose id is derived from the job, the
path and the modified time.  A run takes all changed files together, in a
number of Spark jobs that does not depend on theirs: the listing, one look at
the headers, one write that puts every row into its file's batch, one manifest
write.  The data is written before the manifest, so a crash in between re-takes
those file versions on the next run under the same batch ids and replaces what
the crashed run wrote, whatever other files have changed meanwhile.  A file
rewritten under the same name is a new batch; the rows of its earlier version
stay, as an earlier load.

Spark's streaming file source is not used as the default: it remembers
paths, so a file rewritten under the same name is never read again.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.functions.names import col_of
from wardstat.sources.sinks import BATCH_COL, append_batch, append_batches

BROADCAST_FILES = 500_000  # changed files whose names are broadcast: about 100 MB

# --- fixed values ----------------------------------------------------------------
FIRST_RUN_FLOOR = _dt.datetime(1900, 1, 1, 0, 0, 0)
CSV_KIND = "text/csv"
MASTER_FILE = "PBJ_Daily_Nurse_Staffing_Q2_2024.csv"
JOB_FILES = {  # which landed files each silver job takes
    "silver-master": (MASTER_FILE,),
    "silver-provider": ("NH_ProviderInfo_Oct2024.csv",),
    "silver-mds": ("NH_QualityMsr_MDS.csv", "NH_QualityMsr_MDS_Oct2024.csv"),
    "silver-claims": ("NH_QualityMsr_Claims_Oct2024.csv",),
    "silver-facility": ("FY_2024_SNF_VBP_Facility_Performance.csv",),
    "silver-skilled": ("Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data_Oct2024.csv",),
}
TRANSACTION_FILES = tuple(name for job, names in JOB_FILES.items() if job != "silver-master" for name in names)
# ----------------------------------------------------------------------------------


def list_files(spark: SparkSession, root: str, glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """Listing of ``root`` as a DataFrame ``(path, name, modified, length)``.

    Uses the ``binaryFile`` source with only metadata columns selected, so
    file contents are never read; the listing itself is distributed by
    Spark's file index for large folders.
    """
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
        .select("path", "modificationTime", "length")
    )
    return df.select(
        F.col("path"),
        F.regexp_extract(F.col("path"), r"([^/]+)$", 1).alias("name"),
        F.col("modificationTime").alias("modified"),  # an instant: compares the same in any zone
        F.col("length"),
    )


def allow_listed(
    listing: DataFrame,
    names: Sequence[str] | None = TRANSACTION_FILES,
    name_col: str = "name",
    kind_col: str | None = None,
    kind: str = CSV_KIND,
    trashed_col: str | None = None,
) -> DataFrame:
    """Files whose name is on the allow-list, of the wanted kind, not deleted.

    Kind and deletion are only tested when the listing carries them.
    """
    cond = F.lit(True)
    if names is not None:
        cond = cond & col_of(name_col).isin(list(names))
    if kind_col is not None:
        cond = cond & (col_of(kind_col) == F.lit(kind))
    if trashed_col is not None:
        t = col_of(trashed_col)
        cond = cond & (t.isNull() | ~t)  # unknown counts as kept; pushable, unlike coalesce
    return listing.filter(cond)


def changed_files(
    listing: DataFrame,
    manifest: DataFrame,
    key: str = "path",
    modified: str = "modified",
    seen: str = "seen",
    floor: _dt.datetime = FIRST_RUN_FLOOR,
) -> DataFrame:
    """Listing rows that are new or modified since the manifest's record.

    Times are compared as timestamps, never as text.  The manifest may hold
    several records per file (one per run); the latest counts.
    """
    last = manifest.groupBy(col_of(key).alias(key)).agg(F.max(col_of(seen)).alias("__seen"))
    joined = listing.join(last, on=key, how="left")
    # built from text so neither the Python process zone nor the session zone shifts it
    floor_lit = F.lit(floor.isoformat(sep=" ")).cast(joined.schema[modified].dataType)
    return joined.filter(col_of(modified) > F.coalesce(F.col("__seen"), floor_lit)).drop("__seen")


def read_manifest(spark: SparkSession, manifest_path: str, job: str | None = None) -> DataFrame:
    """The manifest (of one job), or an empty one before the first run.  Read
    with its declared schema, so a folder without data files is empty too."""
    from wardstat.sources.files import read_or_empty

    schema = "job string, path string, seen timestamp, batch_id string"
    table = read_or_empty(spark, manifest_path, schema)
    return table if job is None else table.filter(F.col("job") == F.lit(job))


def record_file(spark: SparkSession, manifest_path: str, job: str, path: str, seen_micros: int, batch: str) -> None:
    """Record one taken file version; call only after its data is written."""
    record_files(spark, manifest_path, job, [(path, seen_micros)], batch)


def record_files(spark: SparkSession, manifest_path: str, job: str, files: Sequence[tuple[str, int]], batch: str) -> None:
    """Record taken file versions, as one batch of the manifest.  The times
    travel as microseconds, instants in any zone."""
    rows = spark.createDataFrame(list(files), "path string, micros long")
    rows = rows.select(F.lit(job).alias("job"), "path", F.timestamp_micros("micros").alias("seen"))
    append_batch(rows.coalesce(1), manifest_path, batch)


def batch_id_for(job: str, path: str, seen_micros: int) -> str:
    """The batch id of one file version for one job."""
    return "file-" + hashlib.sha1(f"{job}\t{path}\t{seen_micros}".encode()).hexdigest()[:20]


def _taken(listing: DataFrame, manifest: DataFrame) -> list[tuple[str, int]]:
    """The changed files.  Their names reach the driver, as any read of them
    needs them there; their rows never do."""
    changed = changed_files(listing, manifest)
    rows = changed.select("path", F.unix_micros(F.col("modified").cast("timestamp")).alias("micros")).collect()
    return sorted({(r.path, r.micros) for r in rows}, key=lambda x: (x[1], x[0]))


def _run_id(batches: Sequence[str]) -> str:
    """One id for the same files in the same versions, whatever their order."""
    return "run-" + hashlib.sha1("\n".join(sorted(batches)).encode()).hexdigest()[:20]


def ingest_changed(
    spark: SparkSession,
    listing: DataFrame,
    manifest_path: str,
    target: str,
    transform,
    run_id: str | None = None,
    reader=None,
    fmt: str = "parquet",
    job: str = "",
) -> int:
    """One intake run: all changed files are read together, cleaned with
    ``transform`` (a silver job), appended to ``target``, each as its own
    batch, and recorded.  Returns the number of files taken.

    ``transform`` gets the rows of all files, with the column ``batch_id``,
    and must work row by row and leave that column in its result.  ``reader``
    (default ``read_csv``) is called with the session, the paths and
    ``file_col``, the name under which it has to add each row's file.
    ``run_id`` only prefixes the batch ids, so using it again never replaces
    another file's rows.
    """
    from wardstat.sources.files import path_key, read_csv, uri_key

    taken = _taken(listing, read_manifest(spark, manifest_path, job))
    if not taken:
        return 0
    names = [batch_id_for(job, path, micros) for path, micros in taken]
    names = [f"{run_id}-{n}" if run_id else n for n in names]
    rows = (reader or read_csv)(spark, [path for path, _ in taken], file_col=_FILE)
    known = spark.createDataFrame([(path, n) for (path, _), n in zip(taken, names)], f"path string, {BATCH_COL} string")
    known = known.select(path_key("path").alias(_KEY), BATCH_COL)
    if len(taken) <= BROADCAST_FILES:  # names that the driver holds already; beyond that a shuffle meets them
        known = F.broadcast(known)
    rows = rows.drop(BATCH_COL).withColumn(_KEY, uri_key(_FILE)).join(known, _KEY).drop(_KEY, _FILE)
    append_batches(transform(rows), target, fmt=fmt)
    record_files(spark, manifest_path, job, taken, _run_id(names))
    return len(taken)


_FILE, _KEY = "__file", "__file_key"


def rebuild_if_changed(
    spark: SparkSession,
    listing: DataFrame,
    manifest_path: str,
    write,
    reader=None,
    job: str = "",
) -> int:
    """For a table that is rebuilt from all its files: when any listed file
    is new or changed, ``write`` gets *all* listed files' rows, aligned by
    column name; then the changed ones are recorded.  Returns their number.

    The listed paths reach the driver, as a read of them needs them there.
    """
    from wardstat.sources.files import read_csv

    taken = _taken(listing, read_manifest(spark, manifest_path, job))
    if not taken:
        return 0
    paths = [r.path for r in listing.select("path").distinct().orderBy("path").collect()]
    write((reader or read_csv)(spark, paths))
    record_files(spark, manifest_path, job, taken, _run_id([batch_id_for(job, *t) for t in taken]))
    return len(taken)
