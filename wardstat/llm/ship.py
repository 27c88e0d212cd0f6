"""Makes this package importable in the Python workers of any executor."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import wardstat

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source to the executors, once per application.

    ``addPyFile`` serves the zip from the driver, so workers need neither a
    shared folder nor an installed copy, and a new executor fetches it too.
    """
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = os.path.dirname(os.path.abspath(wardstat.__file__))
    path = os.path.join(tempfile.mkdtemp(), "wardstat_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("wardstat", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _DONE.add(sc.applicationId)
