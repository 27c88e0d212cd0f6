"""Rollups kept load by load, and tables stored in order."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardstat.plans import gold, jobs, partials
from wardstat.sources.files import read_table
from wardstat.sources.ordered import overwrite_sorted, read_range, stored_bounds
from wardstat.sources.sinks import append_batch, current_folder, overwrite

SILVER = "PROVNUM string, PROVNAME string, STATE string, WorkDate date, Hrs_RNDON double, TotalNursing_Hours double, MDScensus double, RN_Ratio double, CNA_Ratio double"


def staffing(spark, seed, n=200):
    rng = random.Random(seed)
    some = lambda: rng.choice([None, 0.0, 1.0, 2.5, 8.0])
    out = []
    for _ in range(n):
        p = rng.choice(["1", "2", "3", None])
        out.append((p, f"H{p}", rng.choice(["AL", "TX", None]), dt.date(2024, 1, rng.randrange(1, 5)), some(), some(), some(), some(), some()))
    return spark.createDataFrame(out, SILVER)


def close(a, b):
    norm = lambda df: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df.select(*sorted(df.columns)))]
    assert norm(a) == norm(b)


def spoil(folder):
    """Files that can no longer be read, with the times they had."""
    for name in glob.glob(f"{folder}/*.parquet"):
        at = os.stat(name)
        with open(name, "wb") as f:
            f.write(b"gone")
        os.utime(name, ns=(at.st_atime_ns, at.st_mtime_ns))


def age(path):
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        at = os.stat(name)
        os.utime(name, ns=(at.st_atime_ns, at.st_mtime_ns - 10**10))


def test_staffing_partials_equal_a_rebuild(spark, tmp_path):
    path, states = str(tmp_path / "silver"), str(tmp_path / "partials")
    with pytest.raises(ValueError):
        partials.staffing_rollups(spark, path, states)
    for k in range(4):
        append_batch(staffing(spark, k), path, f"load {k}")
        age(path)
        if k == 3:
            whole = jobs.staffing_rollups(read_table(spark, path))
            want = rows(whole.select(*sorted(whole.columns)))
            for old in range(3):
                spoil(f"{path}/batch_id=load {old}")
        assert partials.refresh_staffing(spark, path, states) == [f"load {k}"]
        assert partials.refresh_staffing(spark, path, states) == []
    got = partials.staffing_rollups(spark, path, states)
    norm = lambda rs: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rs]
    assert norm(rows(got.select(*sorted(got.columns)))) == norm(want)


def test_partials_of_replayed_and_removed_loads(spark, tmp_path):
    path, states = str(tmp_path / "silver"), str(tmp_path / "partials")
    for k in range(3):
        append_batch(staffing(spark, k), path, f"load{k}")
    age(path)
    assert partials.refresh_staffing(spark, path, states) == ["load0", "load1", "load2"]
    age(states)
    append_batch(staffing(spark, 9), path, "load1")
    assert partials.stale_loads(spark, path, states) == ["load1"]
    partials.refresh_staffing(spark, path, states)
    close(partials.staffing_rollups(spark, path, states), jobs.staffing_rollups(read_table(spark, path)))
    for name in glob.glob(f"{path}/batch_id=load2/*") + glob.glob(f"{path}/batch_id=load2/.*"):
        os.unlink(name)
    os.rmdir(f"{path}/batch_id=load2")
    close(partials.staffing_rollups(spark, path, states), jobs.staffing_rollups(read_table(spark, path)))


def test_bed_utilization_from_counts(spark, tmp_path):
    prov = spark.createDataFrame([("1", "A", 10.0, 20.0), ("2", "B", 5.0, 0.0), ("3", "A", None, 8.0), ("4", "B", 9.0, 10.0)],
                                 f"{gold.CCN} string, State string, {gold.RESIDENTS} double, {gold.BEDS} double")
    mds, counts = str(tmp_path / "mds"), str(tmp_path / "counts")
    for k, n in enumerate((30, 70)):
        load = spark.range(n).select((F.col("id") % 5).cast("string").alias(gold.CCN), F.when(F.col("id") % 4 > k, "long").alias("Resident_type"))
        append_batch(load, mds, f"l{k}")
        partials.refresh_mds_counts(spark, mds, counts, ["Resident_type"])
    for by in (["Resident_type"], ["State"], ["State", "Resident_type"]):
        got = partials.bed_utilization(spark, prov, mds, counts, by, "rate", mds_by=["Resident_type"])
        close(got, gold.bed_utilization(prov, read_table(spark, mds).drop("batch_id"), by, "rate", stamp=None))


KEYS = [(None, 1), (dt.date(2024, 1, 1), 2), *[(dt.date(2024, 1, 1) + dt.timedelta(days=i % 90), i) for i in range(3000)], (dt.date(1999, 1, 1), -1)]


def test_files_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(KEYS, "day date, v int").repartition(7)
    overwrite_sorted(df, path, ["day", "v"], files=5)
    bounds = stored_bounds(spark, path).collect()
    assert len(bounds) == 5 and sum(b.n for b in bounds) == len(KEYS)
    ends = [((e.day or dt.date.min), e.v) for b in bounds for e in (b["first"], b["last"])]
    assert ends == sorted(ends)
    in_order = []
    for b in bounds:  # file by file, row by row, without sorting
        in_order += [(r.day or dt.date.min, r.v) for r in spark.read.parquet(f"{current_folder(spark, path)}/{b.file}").coalesce(1).collect()]
    assert in_order == sorted(in_order) and len(in_order) == len(KEYS)
    assert rows(read_table(spark, path)) == rows(df)


@pytest.mark.parametrize("low,high", [("2024-02-01", "2024-02-05"), (None, "2024-01-01"), ("2024-03-20", None), ("2030-01-01", None), (None, None), (None, "1990-01-01")])
def test_a_range_opens_only_its_files(spark, tmp_path, low, high):
    path = str(tmp_path / "t")
    overwrite_sorted(spark.createDataFrame(KEYS, "day date, v int"), path, ["day", "v"], files=6)
    bound = [dt.date.fromisoformat(x) if x else None for x in (low, high)]
    got = read_range(spark, path, *bound)
    want = [(d, v) for d, v in KEYS if (low is None and high is None) or (d is not None and (low is None or d >= bound[0]) and (high is None or d <= bound[1]))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and got.columns == ["day", "v"]
    opened = len(got.inputFiles())
    assert opened == 6 if low is None and high is None else opened < 4


def test_unordered_and_empty_tables(spark, tmp_path):
    overwrite(spark.range(3), str(tmp_path / "a"))
    with pytest.raises(ValueError):
        read_range(spark, str(tmp_path / "a"), 1)
    overwrite_sorted(spark.range(0), str(tmp_path / "b"), "id")
    assert read_range(spark, str(tmp_path / "b"), 1).count() == 0 and read_range(spark, str(tmp_path / "b")).columns == ["id"]
    overwrite_sorted(spark.createDataFrame([("b", 1), ("aé", 2)], "`a b` string, n int"), str(tmp_path / "c"), "a b", files=2)
    assert [r.n for r in read_range(spark, str(tmp_path / "c"), None, "aé").collect()] == [2]
