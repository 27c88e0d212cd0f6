"""Small files of a table (its schema, its version pointer) on any store.

They are read and written through the file system that Spark itself uses for
the path, without a Spark job.  A file is written beside its place and renamed
onto it, so a reader sees the old text or the new one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path) of the store that holds the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place))


def changed(spark: SparkSession, path: str) -> int:
    """The newest modification time of the files in a folder, in ms; 0 if it
    has none."""
    store, place = _at(spark, path)
    return max([0, *(s.getModificationTime() for s in store.listStatus(place))]) if store.exists(place) else 0


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file; None if there is none."""
    store, place = _at(spark, path)
    if not store.exists(place) or store.getFileStatus(place).isDirectory():
        return None
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace the text of a file."""
    jvm = spark._jvm
    folder, _, name = path.rpartition("/")
    store, fresh = _at(spark, f"{folder}/_{name.lstrip('_')}.{uuid.uuid4().hex[:12]}.tmp")
    stream = store.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    place = store.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    files.rename(store.makeQualified(fresh), place, how)


def delete(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)
