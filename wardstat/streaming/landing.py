"""Structured Streaming intake for landing folders whose files never change.

``run_landing_once`` drains every file that arrived since the last run
(``trigger(availableNow=True)``), applies a silver function per micro-batch
and appends each batch with the query's id and its epoch as the batch id.
The query's id is kept in the checkpoint, so a replayed epoch replaces its
own output and an executor or driver loss between write and commit never
duplicates rows, while a stream that starts from another checkpoint (or a
lost one) gets another id and replaces nothing.

A file rewritten under the same name is *not* seen again by the file
source; use ``sources.intake.changed_files`` for such folders.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wardstat.sources.sinks import append_batch


def landing_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """A streaming DataFrame over new files in ``folder`` (declared schema)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(folder)


def run_landing_once(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    target: str,
    transform: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    fmt: str = "csv",
    out_fmt: str = "parquet",
) -> str:
    """Take every file that is new to ``checkpoint`` once, clean it with
    ``transform``, append to ``target``; returns the checkpoint location."""
    if not checkpoint:
        raise ValueError("a checkpoint folder is needed: it says which files were taken")
    known = threading.Event()
    name: list[str] = []

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        known.wait()
        append_batch(transform(batch), target, f"{name[0]}-{epoch_id:012d}", fmt=out_fmt)

    query = (
        landing_stream(spark, folder, schema, fmt)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    name.append(str(query.id))
    known.set()
    query.awaitTermination()
    return checkpoint
