"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast only when the measured side is under the
# broadcast threshold), splits skewed shuffle partitions and coalesces
# small ones, so no stage is hand-sized for one data scale.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "wardstat",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is only passed for local runs; on a cluster the launcher
    decides it.  ``shuffle_partitions`` is the initial partition count AQE
    starts from; leave it unset on a cluster and size it from the data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only in local mode, where all tasks share the machine's
    disk, a fresh folder is created when it is unset; on a cluster that would
    be a different folder on every machine, so it raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext here
        return _connect_checkpoint_dir(spark)
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(named or _local_folder(sc.master))
    return sc.getCheckpointDir()


def _local_folder(master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="wardstat-ckpt-")


_LOCAL_FALLBACK: dict[int, str] = {}


def _connect_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from the session conf; a local temporary
    folder only when none is named (local runs)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if id(spark) not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[id(spark)] = _local_folder(spark.conf.get("spark.master", ""))
    return _LOCAL_FALLBACK[id(spark)]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Used for written intermediate tables and sink round trips; never a
    machine-local folder when the cluster names a shared one.
    """
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def scale_conf(
    shuffle_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    scan_split_bytes: int = 256 * 1024 * 1024,
    max_partitions: int = 50_000,
) -> dict[str, str]:
    """Starting settings for a large cluster, to pass as ``extra_conf``.

    ``shuffle_bytes`` is the largest shuffle a job writes (after column
    pruning and map-side aggregation), ``total_cores`` the executor cores.
    The initial partition count gives each reducer about
    ``target_partition_bytes`` and at least two waves' worth of tasks; AQE
    then coalesces small partitions and splits skewed ones at runtime, so
    the number only has to be large enough, never exact.

    A shuffle has as many blocks as map tasks times reducers.  Beyond
    ``max_partitions`` reducers each one gets more than the target instead
    (2 GB at 100 TB), and a scan split grows alike, so 100 TB make about
    5 * 10^4 x 5 * 10^4 = 2.5 * 10^9 blocks, of 40 KB each, not 10^11.
    """
    parts = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    if parts > max_partitions:
        parts = max(2 * total_cores, max_partitions)
        target_partition_bytes = -(-shuffle_bytes // parts)
        scan_split_bytes = max(scan_split_bytes, target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
