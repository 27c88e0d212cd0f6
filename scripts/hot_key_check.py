"""Measure what a hot key costs the latest-record pick and a join.

    python scripts/hot_key_check.py [rows] [map_partitions]

One key holds a third of the rows.

1. Latest record per key, with Spark's pre-shuffle WindowGroupLimit (the
   default plan) and with it disabled.
2. A sort-merge join of those rows to a one-row-per-key dimension (broadcast
   off, standing in for a side too large to broadcast): AQE's skew split
   (its size thresholds scaled down to this test size; at scale the hot
   partition is many GB), the salted join, and neither.

The event log (written to a fresh scratch folder) gives the largest number
of shuffle records one reduce task read in each run.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wardstat.operators.dedup import latest_per_key  # noqa: E402
from wardstat.operators.joins import join_keep_left  # noqa: E402
from wardstat.session import build_session  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 48
    log_dir = tempfile.mkdtemp(prefix="wardstat-hotkey-")
    spark = build_session(
        "local[8]", shuffle_partitions=16,
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir},
    )
    # every third row belongs to key HOT; the rest spread over 100,000 keys
    df = spark.range(n, numPartitions=parts).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 100_000).cast("string")).alias("ccn"),
        F.col("id").alias("seq"),
        (F.col("id") * 7 % 1000).cast("timestamp").alias("stamp"),
    )
    for label, threshold in (("latest: with pre-shuffle limit", None), ("latest: limit disabled", "-1")):
        if threshold:
            spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
        spark.sparkContext.setJobDescription(label)
        latest_per_key(df, "ccn", stamp="stamp", tie_break="seq").write.format("noop").mode("overwrite").save()
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")

    # a payload that does not compress away: AQE compares compressed sizes
    fact = df.select("ccn", F.sha2(F.col("seq").cast("string"), 256).alias("payload"))
    dim = spark.range(100_001).select(
        F.when(F.col("id") == 100_000, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("ccn"),
        (F.col("id") * 2).alias("beds"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    runs = (
        ("join: AQE skew split", {"spark.sql.adaptive.skewJoin.enabled": "true",
                                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
                                  "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}, None),
        ("join: salted x16", {"spark.sql.adaptive.skewJoin.enabled": "false",
                              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m"}, 16),
        ("join: neither", {"spark.sql.adaptive.skewJoin.enabled": "false"}, None),
    )
    for label, conf, salt in runs:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobDescription(label)
        joined = join_keep_left(dim, fact, "ccn", salt_buckets=salt)
        joined.groupBy("beds").agg(F.max("payload")).write.format("noop").mode("overwrite").save()
    spark.stop()

    label_of, reads = {}, {}
    for path in glob.glob(os.path.join(log_dir, "*", "events_*")):
        with open(path, "rb") as fh:
            for line in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8"):
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    for sid in e["Stage IDs"]:
                        label_of[sid] = e.get("Properties", {}).get("spark.job.description")
                elif e["Event"] == "SparkListenerTaskEnd":
                    r = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if r:
                        reads.setdefault(e["Stage ID"], []).append(r)
    print(f"{n} rows, {n // 3} on one key, {parts} map tasks")
    seen = set()
    for sid, rs in sorted(reads.items()):
        label = label_of.get(sid)
        if label in seen:  # the first shuffle read of each run is the one that matters
            continue
        seen.add(label)
        print(f"  {label}: {len(rs)} reduce tasks, largest read {max(rs)} records, total {sum(rs)}")


if __name__ == "__main__":
    main()
