"""wardstat: facility-metrics operators written as plain Spark DataFrame code.

Layout
------
- ``functions``  Column builders (cleaning, casting, guarded arithmetic,
  correlation and least-squares aggregates).
- ``operators``  ``DataFrame -> DataFrame`` steps (trim/rename, latest record
  per key, joins that keep one side's columns, filters, top-N, checks).
- ``sources``    CSV / table readers, sinks, and the changed-file intake.
- ``plans``      the composite jobs: raw -> silver, silver -> gold, serving
  (chart-ready frames) and data-quality counts.
- ``streaming``  Structured Streaming intake for landing zones whose files
  never change.
"""

from wardstat.session import build_session, scale_conf, scratch_path

__all__ = ["build_session", "scale_conf", "scratch_path"]
