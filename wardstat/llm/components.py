"""Connected components by alternating large-star and small-star steps.

Distributed union-find on an edge table: every step is a map-side combined
minimum per node and a join back, so a hub with very many neighbours is an
ordinary skewed join that adaptive execution can split, and nothing is
gathered in one task or on the driver.  The edges are written to the shared
folder after every round, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.session import scratch_path
from wardstat.sources import fs


TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end;
    otherwise these stay until the driver collects its garbage."""
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once all that was read from them
    is itself written."""
    for t in tables:
        fs.delete(t.sparkSession, t.scratch_folder)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select("u", F.col("m").alias("v"))
    return moved.union(own).filter("u != v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has
    an edge to another one.  Null ends and loops are ignored; an empty edge
    table gives no rows."""
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u != v")
    now = written(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    # done when every node has exactly one edge, to a node that has none above:
    # the edges are then stars around the smallest node
    while True:
        nodes = now.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        crowded = nodes.filter("n > 1").limit(1).count()
        chained = 0 if crowded else now.join(now.select(F.col("u").alias("w")), F.col("v") == F.col("w")).limit(1).count()
        if not crowded and not chained:
            break
        closer = written(_small_star(_large_star(now)), "components")
        discard(now)
        now = closer
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
