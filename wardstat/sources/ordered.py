"""Tables stored in order, and reads that open only the files they need.

The rows are range-partitioned and sorted, so a file holds one stretch of the
order and the files follow each other end to end.  Where each file begins and
ends is found once, from the sort columns alone, and stored with the table's
version; a read of a range lists the files whose stretch meets it and opens no
others.  Rows that are equal in all sort columns lie in one file, so the last
sort column should tell rows apart where a key can hold very many.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardstat.functions.names import col_of
from wardstat.sources.sinks import current_folder, overwrite, read_note, stored_schema
from wardstat.sources.widen import as_columns

BOUNDS = "_bounds"


def overwrite_sorted(df: DataFrame, path: str, by: Sequence[str], files: int | None = None, fmt: str = "parquet") -> None:
    """Replace the table by the rows in the order of ``by`` (NULLs first), in
    ``files`` files, or as many as the shuffle makes (AQE sizes them)."""
    by = [by] if isinstance(by, str) else list(by)
    columns = [col_of(c) for c in by]
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)

    def bounds(folder: str) -> dict[str, str]:
        spark = df.sparkSession
        rows = spark.read.format(fmt).schema(stored_schema(spark, folder)).load(folder)
        key = F.struct(*[col_of(c) for c in by])
        found = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n"))
        told = found.orderBy("first").select(F.to_json(F.struct("file", "first", "last", "n"), {"ignoreNullFields": "false"}).alias("j"))
        return {BOUNDS: json.dumps({"by": by, "kinds": kinds, "files": [json.loads(r.j) for r in told.collect()]})}  # a row per file

    overwrite(ranged.sortWithinPartitions(*columns), path, fmt=fmt, notes=bounds)


def stored_bounds(spark: SparkSession, path: str) -> DataFrame | None:
    """(file, first, last, n) per file in the table's order; None where the
    table was not stored in order."""
    text = read_note(spark, path, BOUNDS)
    if text is None:
        return None
    told = json.loads(text)
    kind = f"struct<{_struct(told['kinds'])}>"
    rows = spark.createDataFrame([(i, json.dumps(f)) for i, f in enumerate(told["files"])], "place int, j string")
    parsed = rows.select("place", F.from_json("j", f"file string, first {kind}, last {kind}, n long").alias("r"))
    return parsed.orderBy("place").select("r.*")


def _struct(kinds: str) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in StructType.fromDDL(kinds).fields)


def _lead(spark: SparkSession, path: str) -> str:
    return json.loads(read_note(spark, path, BOUNDS))["by"][0]


def read_range(spark: SparkSession, path: str, low=None, high=None, fmt: str = "parquet") -> DataFrame:
    """The rows whose first sort column is in [low, high] (None: no bound; a
    value or a literal Column), from the files that can hold such rows.  NULLs
    are in no range with a bound."""
    bounds = stored_bounds(spark, path)
    if bounds is None:
        raise ValueError(f"{path} is not stored in order")
    lead = _lead(spark, path)
    at = lambda v: v if isinstance(v, Column) else F.lit(v)
    schema, folder = stored_schema(spark, path), current_folder(spark, path)
    meets, inside = F.lit(True), F.lit(True)
    if low is not None:
        meets, inside = meets & (F.col("last")[lead] >= at(low)), inside & (col_of(lead) >= at(low))
    if high is not None:
        # a file that begins with NULLs may go on with values
        meets, inside = meets & (F.coalesce(F.col("first")[lead] <= at(high), F.lit(True))), inside & (col_of(lead) <= at(high))
    names = [r.file for r in bounds.filter(meets).select("file").collect()]
    if not names:
        return as_columns(spark.createDataFrame([], schema), schema)
    rows = spark.read.format(fmt).schema(schema).load([f"{folder}/{n}" for n in names])
    return as_columns(rows, schema).filter(inside)
