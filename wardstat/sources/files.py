"""Readers: CSV files, stored tables, and "missing table -> empty frame"."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from wardstat.functions.names import col_of
from wardstat.sources.sinks import current_folder, stored_schema
from wardstat.sources.widen import as_columns

FILE_SPLIT = 1 << 42  # a split larger than any file: one task per file
# options that change what a file's first line is; their files' headers are left to Spark
_OTHER_LINES = {"encoding", "charset", "multiline", "linesep", "comment", "skiprows"}


def path_key(path) -> Column:
    """A listed path in the spelling that ``uri_key`` gives it."""
    return F.regexp_replace(col_of(path), r"^([a-zA-Z][a-zA-Z0-9+.-]*):/+", "$1:/")


def uri_key(uri) -> Column:
    """What Spark says of a row's file, a URI, as the path that it lists: with
    one slash behind the scheme and without escapes (a plus is no escape)."""
    plain = path_key(uri)
    return F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, header): the first line of every file, from one job.

    A task opens one file and stops after its first line, so the job reads a
    buffer of each file, whatever their sizes.  Empty files have no row."""
    own = spark.newSession()  # the caller's settings stay as they are
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, str(FILE_SPLIT))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = own.read.text(list(paths)).select(uri_key(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("header"))

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([c.slice(0, 1) for c in batch.columns], names=["file", "header"])
                return

    return lines.mapInArrow(first, "file string, header string")


def header_names(line: str, sep: str = ",", quote: str = '"') -> list[str]:
    """Column names of a header line, as Spark's reader names them: an empty
    one by its place, repeated ones with their place behind them."""
    names = next(csv.reader([line], delimiter=sep, quotechar=quote or None, quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    file_col: str | None = None,
    **options,
) -> DataFrame:
    """Read CSV with a header.

    Without ``schema`` every column is a string (keys such as ``015009`` keep
    their leading zero); typing is done afterwards with ``try_cast`` so bad
    text becomes NULL, or by ``sources.infer``.  With a declared ``schema`` the
    header names are checked against it.

    Spark takes one file's header for all files of a read and maps the others
    by position.  So without a schema the headers of all files, in folders
    too, are found in one job; files that share one are read together, and the
    groups are joined by column name; a column that a file lacks is NULL for
    its rows.

    ``file_col`` names a further column with each row's file.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    paths = [paths] if isinstance(paths, str) else list(paths)
    rows = lambda df: df if file_col is None else df.select("*", F.col("_metadata.file_path").alias(file_col))
    if schema is not None or not header or _OTHER_LINES & {k.lower() for k in options}:
        return rows(reader.csv(paths))
    own = {k.lower(): v for k, v in options.items()}
    sep, quote = own.get("sep", own.get("delimiter", ",")), own.get("quote", '"')
    if len(sep) != 1 or len(quote) > 1:
        return rows(reader.csv(paths))
    found = file_headers(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"), F.count(F.lit(1)).alias("n"))
    groups = sorted(found.collect(), key=lambda r: r.files[0])  # a list of files, as a read needs it on the driver
    if not groups:
        return rows(reader.csv(paths))  # nothing but empty files
    parts = []
    for g in groups:
        names = StructType([StructField(n, StringType()) for n in header_names(g.header, sep, quote)])
        parts.append(rows(reader.schema(names).option("enforceSchema", True).csv(paths if len(groups) == 1 else g.files)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Read a stored table, in the version that its pointer names, with the
    fields stored beside it, which hold every column any batch brought, and
    each column as the type that holds all its batches'.  A table without
    them (written by something else) is read as Spark finds it;
    ``merge_schema`` then looks at every file's footer."""
    schema, folder = stored_schema(spark, path), current_folder(spark, path)
    reader = spark.read.format(fmt)
    if schema is not None:
        return as_columns(reader.schema(schema).load(folder), schema)
    if merge_schema and fmt in ("parquet", "orc"):
        reader = reader.option("mergeSchema", "true")
    return reader.load(folder)


def read_or_empty(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """Read a table, or an empty frame of ``schema`` when the path does not
    exist or is a folder without data files (what a crashed write leaves).
    Any other failure propagates."""
    try:
        return read_table(spark, path, fmt, merge_schema)
    except AnalysisException as exc:
        missing = ("PATH_NOT_FOUND", "Path does not exist", "UNABLE_TO_INFER_SCHEMA")
        if any(m in str(exc) for m in missing):
            return spark.createDataFrame([], schema)
        raise
