"""Reading and taking in many CSV files at once."""

import os

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tests.conftest import rows
from wardstat.operators.columns import trim_all
from wardstat.sources import infer
from wardstat.sources.files import file_headers, header_names, path_key, read_csv, read_table, uri_key
from wardstat.sources.intake import ingest_changed, list_files, rebuild_if_changed
from wardstat.sources.sinks import BATCH_COL


def jobs_of(spark, group, call):
    """How many Spark jobs a call runs."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = call()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def files(folder, n, first=0):
    for i in range(first, first + n):
        header, row = (["id", "v", "w"], [i, f" v{i} ", "x"]) if i % 2 else (["w", "id"], ["y", i])
        fx.write_csv(str(folder), f"f {i}+%.csv", header, [row, row])


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    files(tmp_path, 60)
    (tmp_path / "empty.csv").write_text("")
    found, jobs = jobs_of(spark, "headers", lambda: file_headers(spark, [str(tmp_path)]).collect())
    assert jobs == 1 and len(found) == 60 and {r.header for r in found} == {"id,v,w", "w,id"}
    df = read_csv(spark, str(tmp_path))
    assert sorted(df.columns) == ["id", "v", "w"] and df.count() == 120
    assert df.filter("v is null").count() == 60 and df.filter("w = 'y'").count() == 60
    assert df.agg(F.sum("id")).first()[0] == 2 * sum(range(60))


def test_a_long_file_is_not_read_for_its_header(spark, tmp_path):
    with open(tmp_path / "a.csv", "w") as f:
        f.write("a;b\n")
        f.writelines(f"{i};x\n" for i in range(200_000))
    assert [r.header for r in file_headers(spark, [str(tmp_path)]).collect()] == ["a;b"]
    assert read_csv(spark, str(tmp_path), sep=";").filter("b = 'x'").count() == 200_000


@pytest.mark.parametrize("line,want", [
    ("a,b", ["a", "b"]), ("", []), ('"a, b",,c', ["a, b", "_c1", "c"]), ("a,A,b", ["a0", "A1", "b"]), ('x "y",z', ['x "y"', "z"]),
])
def test_header_names(spark, tmp_path, line, want):
    assert header_names(line) == want
    if want:
        (tmp_path / "a.csv").write_text(line + "\n" + ",".join("1" * len(want)) + "\n")
        assert spark.read.option("header", True).csv(str(tmp_path)).columns == want  # as Spark has them


def test_file_keys_meet(spark, tmp_path):
    files(tmp_path, 3)
    fx.write_csv(str(tmp_path), "a%41.csv", ["id"], [[1]])
    listed = list_files(spark, str(tmp_path)).select(path_key("path")).collect()
    told = read_csv(spark, str(tmp_path), file_col="f").select(uri_key("f")).distinct().collect()
    assert sorted(listed) == sorted(told) and len(listed) == 4


def test_one_run_takes_many_files_in_few_jobs(spark, tmp_path):
    def run(n, first, name):
        land, target, manifest = (str(tmp_path / f"{name}-{x}") for x in ("land", "target", "manifest"))
        files(land, n, first)
        take = lambda m=manifest: ingest_changed(spark, list_files(spark, land), m, target, trim_all, job="j")
        taken, jobs = jobs_of(spark, name, take)
        assert taken == n
        return land, target, manifest, take, jobs

    *_, some = run(80, 0, "some")  # beyond 32 paths of a read Spark lists them in a job
    land, target, manifest, take, many = run(150, 0, "many")
    assert many == some < 15
    t = read_table(spark, target)
    assert t.count() == 300 and t.select(BATCH_COL).distinct().count() == 150
    assert rows(t.filter("id = 7").select("v", "w")) == [("v7", "x")] * 2
    assert take() == 0
    # a run that crashed before its manifest: the same batches, with further files beside them
    files(land, 5, 150)
    assert take(str(tmp_path / "lost")) == 155
    assert take() == 5
    t = read_table(spark, target)
    assert t.count() == 310 and t.select(BATCH_COL).distinct().count() == 155
    os.utime(os.path.join(land, "f 0+%.csv"), (10**9, 2 * 10**9))  # a new version of one file
    assert take() == 1
    assert read_table(spark, target).filter("id = 0").count() == 4


def test_a_transform_that_loses_the_batch_is_refused(spark, tmp_path):
    files(tmp_path / "l", 2)
    with pytest.raises(ValueError, match=BATCH_COL):
        ingest_changed(spark, list_files(spark, str(tmp_path / "l")), str(tmp_path / "m"), str(tmp_path / "t"), lambda df: df.select("id"))
    assert not os.path.exists(tmp_path / "t")


def test_rebuild_records_all_files_at_once(spark, tmp_path):
    files(tmp_path / "l", 40)
    got = []
    take = lambda: rebuild_if_changed(spark, list_files(spark, str(tmp_path / "l")), str(tmp_path / "m"), lambda df: got.append(df.count()), job="j")
    assert take() == 40 and take() == 0 and got == [80]


def test_inferred_types(spark, tmp_path):
    data = {
        "ccn": ["015009", "1", " ", "2"], "n": ["1", "-2", "", "+3"], "big": ["1", "3000000000", "", ""], "x": ["1", "2.5", "-1e3", "0."],
        "huge": ["99999999999999999999", "1", "", ""], "over": ["1e400", "1", "2", "3"], "day": ["2024-01-02", " 2024-02-29", "", ""],
        "badday": ["2024-02-30", "2024-01-01", "", ""], "at": ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02T03:04:05.5", ""],
        "flag": ["TRUE", "false", "", "True"], "none": ["", " ", "", ""], "text": ["a", "1", "", ""], "nan": ["NaN", "1", "2", "3"],
    }
    path = fx.write_csv(str(tmp_path), "a.csv", list(data), list(zip(*data.values())))
    df = read_csv(spark, path)
    types, jobs = jobs_of(spark, "infer", lambda: infer.inferred_types(df, keep_text=["n2"]))
    assert types == {
        "ccn": "string", "n": "int", "big": "bigint", "x": "double", "huge": "double", "over": "string", "day": "date", "badday": "string",
        "at": "timestamp", "flag": "boolean", "none": "string", "text": "string", "nan": "string",
    }
    assert jobs <= 2  # one aggregate; with adaptive execution its two stages are jobs
    typed = infer.with_types(df, types)
    kinds = dict(typed.dtypes)
    assert kinds["n"] == "int" and kinds["day"] == "date" and kinds["at"] == "timestamp_ntz" and kinds["flag"] == "boolean"
    first = typed.first()
    assert first.ccn == "015009" and first.n == 1 and first.flag is True and str(first.day) == "2024-01-02"
    assert typed.filter("flag is null").count() == 1 and typed.filter("ccn = ' '").count() == 1
    assert infer.inferred_types(df, keep_text=["N"])["n"] == "string"
    empty = infer.infer(df.limit(0))
    assert set(dict(empty.dtypes).values()) == {"string"} and empty.count() == 0
    with pytest.raises(ValueError):
        infer.with_types(df, {"other": "int"})
