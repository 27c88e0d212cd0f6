"""Stored tables: types that widen, versions and their pointer, latest-record
snapshots."""

import datetime as dt
import os

import pytest
from pyspark.sql.types import StructType

from tests.conftest import rows
from wardstat.plans.snapshot import known_loads, latest, refresh_latest
from wardstat.sources import fs, sinks
from wardstat.sources.files import read_or_empty, read_table
from wardstat.sources.sinks import BATCH_COL, append_batch, append_batches, batches_in, current_folder, overwrite
from wardstat.sources.widen import TypeConflict, common_type


def typed(kind):
    return StructType.fromDDL(f"c {kind}")["c"].dataType


@pytest.mark.parametrize("a,b,both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("bigint", "float", "double"),
    ("float", "double", "double"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("int", "decimal(5,2)", "decimal(12,2)"),
    ("decimal(38,0)", "decimal(38,10)", "double"), ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("int", "string", "string"), ("boolean", "string", "string"), ("date", "string", "string"), ("void", "int", "int"),
    ("boolean", "int", None), ("date", "int", None), ("timestamp", "timestamp_ntz", None), ("struct<a:int>", "string", None),
    ("binary", "string", None), ("array<int>", "array<int>", "array<int>"), ("array<int>", "array<bigint>", None),
])
def test_common_types(spark, a, b, both):
    for x, y in ((a, b), (b, a)):
        found = common_type(typed(x), typed(y))
        assert (found.simpleString() if found else None) == both


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_batches_of_other_types_are_read_as_the_common_one(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    append_batch(spark.createDataFrame([(1, 5, dt.date(2024, 1, 2))], "id int, v int, d date"), path, "a", fmt=fmt)
    append_batch(spark.createDataFrame([(2**40, "x", None)], "id bigint, V string, d string"), path, "b", fmt=fmt)
    append_batch(spark.createDataFrame([(3, 2.5)], "id int, v double"), path, "c", fmt=fmt)
    append_batch(spark.createDataFrame([(4, 7, None)], "id int, v int, n void"), path, "d", fmt=fmt)
    t = read_table(spark, path, fmt)
    assert t.columns == ["id", "v", "d", "n", BATCH_COL]
    assert [x for _, x in t.dtypes] == ["bigint", "string", "string", "string", "string"]
    want = [(1, "5", "2024-01-02", None, "a"), (2**40, "x", None, None, "b"), (3, "2.5", None, None, "c"), (4, "7", None, None, "d")]
    assert rows(t) == sorted(want, key=str)
    # a batch is replaced, in whatever type it comes again
    append_batch(spark.createDataFrame([(9, "9")], "id int, v string"), path, "a", fmt=fmt)
    assert sorted(r.v for r in read_table(spark, path, fmt).collect()) == ["2.5", "7", "9", "x"]
    assert read_table(spark, path, fmt).filter("id = 9").count() == 1


def test_a_conflict_is_refused_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    append_batch(spark.createDataFrame([(1, True)], "id int, v boolean"), path, "a")
    files = sorted(os.walk(path))
    with pytest.raises(TypeConflict, match="'v'"):
        append_batch(spark.createDataFrame([(1, 2)], "id int, v int"), path, "a")
    assert sorted(os.walk(path)) == files
    assert rows(read_table(spark, path)) == [(1, True, "a")]
    with pytest.raises(ValueError):
        append_batches(spark.range(1), path)


def test_many_batches_in_one_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "concat('day ', id % 7, '/x') as batch_id")
    append_batches(df, path)
    append_batches(df.filter("id < 700"), path)  # replaces the batches it holds
    assert read_table(spark, path).count() == 700
    assert sorted(batches_in(spark, path)) == [f"day {k}/x" for k in range(7)]


class Stop(Exception):
    pass


def _steps(monkeypatch, stop_at):
    """The file operations of an overwrite; the ``stop_at``-th one fails."""
    done = []

    def counted(name):
        real = getattr(fs, name)

        def call(*args):
            done.append(name)
            if len(done) == stop_at:
                raise Stop
            return real(*args)

        return call

    for name in ("write_text", "delete"):
        monkeypatch.setattr(fs, name, counted(name))
    return done


def test_an_overwrite_that_stops_anywhere_leaves_old_or_new_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path)
    overwrite(spark.range(4), path)
    overwrite(spark.range(5), path)
    seen = set()
    for stop_at in range(1, 12):
        before = read_table(spark, path).count()
        with monkeypatch.context() as m:
            done = _steps(m, stop_at)
            try:
                overwrite(spark.range(before + 1), path, notes={"_note": "x"})
                finished = True
            except Stop:
                finished = False
        after = read_or_empty(spark, path, "id long").count()
        assert after in (before, before + 1)
        seen.add((finished, after - before))
        if finished:
            break
    assert finished and seen == {(False, 0), (False, 1), (True, 1)} and "delete" in done
    assert len([n for n in os.listdir(path) if n.startswith(sinks.VERSION)]) == 2  # this one and the one before


def test_a_reader_that_began_before_an_overwrite_ends_with_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(spark.range(3), path)
    old = read_table(spark, path)
    overwrite(spark.range(100, 105), path)
    assert old.count() == 3 and read_table(spark, path).count() == 5


def test_a_table_without_pointer_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(7).write.parquet(path)
    assert read_table(spark, path).count() == 7
    overwrite(spark.range(2).selectExpr("id", "id % 2 as part"), path, partition_by=["part"])
    assert rows(read_table(spark, path)) == [(0, 0), (1, 1)]
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == sorted([sinks.POINTER, os.path.basename(current_folder(spark, path))])


def test_an_unfinished_first_write_is_an_empty_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as m:
        _steps(m, 2)
        with pytest.raises(Stop):
            overwrite(spark.range(3), path)
    assert read_or_empty(spark, path, "id long").count() == 0


LOAD = "k string, v int, stamp timestamp_ntz"


def _load(spark, path, name, day, items):
    append_batch(spark.createDataFrame([(k, v, dt.datetime(2024, 1, day)) for k, v in items], LOAD), path, name)


def test_a_refresh_reads_the_new_loads_only(spark, tmp_path):
    path, snapshot = str(tmp_path / "t"), str(tmp_path / "s")
    _load(spark, path, "a", 1, [("x", 1), ("y", 1), (None, 1)])
    assert refresh_latest(spark, path, snapshot, "k", "stamp", "v").rebuilt
    # old files that cannot be read any more: nothing may look into them
    for folder, _, names in os.walk(os.path.join(path, "batch_id=a")):
        for n in names:
            full, at = os.path.join(folder, n), os.stat(os.path.join(folder, n))
            with open(full, "wb") as f:
                f.write(b"gone")
            os.utime(full, ns=(at.st_atime_ns, at.st_mtime_ns))
    _load(spark, path, "b", 3, [("x", 5), ("x", 7), ("z", 2)])
    _load(spark, path, "c", 2, [("y", 9), ("x", 99)])
    done = refresh_latest(spark, path, snapshot, "k", "stamp", "v")
    assert done.loads == ("b", "c") and not done.rebuilt
    assert [(r.k, r.v) for r in latest(spark, snapshot).orderBy("k").collect()] == [(None, 1), ("x", 7), ("y", 9), ("z", 2)]
    assert sorted(known_loads(spark, snapshot)) == ["a", "b", "c"]
    version = current_folder(spark, snapshot)
    assert refresh_latest(spark, path, snapshot, "k", "stamp", "v").loads == ()
    assert current_folder(spark, snapshot) == version  # nothing was written


def test_a_replayed_load_makes_the_snapshot_anew(spark, tmp_path):
    path, snapshot = str(tmp_path / "t"), str(tmp_path / "s")
    _load(spark, path, "a", 1, [("x", 1), ("y", 1)])
    _load(spark, path, "b", 2, [("x", 5)])
    refresh_latest(spark, path, snapshot, "k", "stamp", "v")
    for folder, _, names in os.walk(os.path.join(path, "batch_id=b")):
        for n in names:
            os.utime(os.path.join(folder, n), (1, 1))  # so that the replay has another time for certain
    refresh_latest(spark, path, snapshot, "k", "stamp", "v")
    _load(spark, path, "b", 2, [("y", 6)])
    assert refresh_latest(spark, path, snapshot, "k", "stamp", "v").rebuilt
    assert [(r.k, r.v) for r in latest(spark, snapshot).orderBy("k").collect()] == [("x", 1), ("y", 6)]
