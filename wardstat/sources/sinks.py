"""Sinks: repeatable appends and overwrites.

An append is written as one partition per batch with dynamic partition
overwrite: replaying a batch after a failure replaces what the failed try
left instead of adding the rows twice.

The stored fields of a table, merged over its batches, are kept in its folder
in the file ``_schema`` (a name that readers skip), so a read needs neither a
look at every file's footer nor an inference job.  They are written before the
rows, so there is no moment when a reader could miss a column.  A column may
come with another type in a later batch (see ``sources.widen``).

An overwrite writes a version folder inside the table's folder and then puts
its name into the file ``_current``, which readers follow: a reader has the
old rows or the new ones, at every moment and after a crash at any step.  The
version before is kept for readers that have begun with it; older ones, and
what crashed tries left, go with the next overwrite.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardstat.sources import fs
from wardstat.sources.widen import forms, stored_form

BATCH_COL = "batch_id"
SCHEMA_FILE = "_schema"
POINTER = "_current"
VERSION = "_v-"


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's rows: the version that the pointer
    names, or the table's own folder where there is no pointer."""
    path = path.rstrip("/")
    name = fs.read_text(spark, f"{path}/{POINTER}")
    return f"{path}/{name.strip()}" if name else path


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The stored fields of a table; None if they are not known."""
    return _schema_in(spark, current_folder(spark, path))


def _schema_in(spark: SparkSession, folder: str) -> StructType | None:
    text = fs.read_text(spark, f"{folder}/{SCHEMA_FILE}")
    if text is None:  # a folder with one text file, as earlier versions of this package wrote it
        parts = [n for n in fs.names(spark, f"{folder}/{SCHEMA_FILE}") if n.startswith("part-")]
        text = fs.read_text(spark, f"{folder}/{SCHEMA_FILE}/{parts[0]}") if parts else None
    return None if text is None else StructType.fromJson(json.loads(text))


def _store_schema(spark: SparkSession, folder: str, schema: StructType) -> None:
    if fs.read_text(spark, f"{folder}/{SCHEMA_FILE}") is None and fs.names(spark, f"{folder}/{SCHEMA_FILE}"):
        fs.delete(spark, f"{folder}/{SCHEMA_FILE}")
    fs.write_text(spark, f"{folder}/{SCHEMA_FILE}", schema.json())


def _batch_last(schema: StructType) -> StructType:
    """The batch column behind the others: Spark reads it from folder names."""
    own = [f for f in schema.fields if f.name.lower() == BATCH_COL]
    return StructType([f for f in schema.fields if f.name.lower() != BATCH_COL] + own)


def append_batch(df: DataFrame, path: str, batch_id: str, fmt: str = "parquet") -> None:
    """Write ``df`` as batch ``batch_id`` of the table at ``path``."""
    append_batches(df.withColumn(BATCH_COL, F.lit(str(batch_id))), path, fmt)


def append_batches(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write rows that name their batch (column ``batch_id``), any number of
    batches in one job; each replaces what the table has of it.

    Raises ``TypeConflict`` before anything is written if a column's type and
    the table's have no common one."""
    if BATCH_COL not in df.columns:
        raise ValueError(f"the rows do not name their batch in a column {BATCH_COL}")
    spark = df.sparkSession
    folder = current_folder(spark, path)
    old = _schema_in(spark, folder)
    merged, columns = stored_form(df.schema, old)
    merged = _batch_last(merged)
    if old != merged:
        _store_schema(spark, folder, merged)
    (
        df.select(*columns)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_COL)
        .save(folder)
    )


def batches_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Batch id -> the time its newest file was written, in ms."""
    folder, mark = current_folder(spark, path), f"{BATCH_COL}="
    found = [n for n in fs.names(spark, folder) if n.startswith(mark)]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return {unescape(n[len(mark) :]): fs.changed(spark, f"{folder}/{n}") for n in found}


def overwrite(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    single_file: bool = False,
    partition_by: Sequence[str] = (),
    notes: Mapping[str, str] | Callable[[str], Mapping[str, str]] | None = None,
) -> None:
    """Replace the table at ``path`` (schema included).

    ``notes`` are small texts, by names that begin with ``_``, that belong to
    this version of the table and are replaced with it (see ``read_note``); a
    function gets the written version's folder and returns them.

    ``single_file=True`` is for small summaries only: it shuffles the result
    into one partition (the upstream stages keep their parallelism, unlike
    ``coalesce(1)`` which would pull the last stage into one task).
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = fs.read_text(spark, f"{path}/{POINTER}")
    version = f"{VERSION}{uuid.uuid4().hex[:12]}"
    schema, columns = stored_form(df.schema, None)
    out = df.select(*columns)
    out = out.repartition(1) if single_file else out
    writer = out.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/{version}")
    last = {p.lower() for p in partition_by}
    kept = [f for f in schema.fields if f.name.lower() not in last]
    _store_schema(spark, f"{path}/{version}", StructType(kept + [forms(schema)[p.lower()][0] for p in partition_by]))
    own = notes(f"{path}/{version}") if callable(notes) else notes or {}
    for name, text in own.items():
        fs.write_text(spark, f"{path}/{version}/{name}", text)
    fs.write_text(spark, f"{path}/{POINTER}", version)
    keep = {version, POINTER, (before or "").strip()}
    for name in fs.names(spark, path):
        own = name.startswith((VERSION, SCHEMA_FILE, "_SUCCESS")) or name.endswith(".tmp") or not name.startswith("_")
        if own and name not in keep:
            fs.delete(spark, f"{path}/{name}")


def read_note(spark: SparkSession, path: str, name: str) -> str | None:
    """A note of the table's current version; None if it has none."""
    return fs.read_text(spark, f"{current_folder(spark, path)}/{name}")
