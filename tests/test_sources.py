import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tests.conftest import rows
from wardstat.plans import silver
from wardstat.sources.files import read_csv, read_or_empty, read_table
from wardstat.sources.intake import (
    TRANSACTION_FILES,
    allow_listed,
    batch_id_for,
    changed_files,
    ingest_changed,
    list_files,
    read_manifest,
    record_file,
)
from wardstat.sources.sinks import BATCH_COL, append_batch, current_folder, overwrite
from wardstat.streaming.landing import run_landing_once


def test_read_csv_keeps_text_and_leading_zeros(spark, tmp_path):
    path = fx.write_csv(str(tmp_path), "p.csv", ["CCN", "Beds"], [["015009", "12"], ["000001", "Not Available"]])
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {"CCN": "string", "Beds": "string"}
    assert sorted(r.CCN for r in df.collect()) == ["000001", "015009"]
    typed = read_csv(spark, path, schema="CCN string, Beds double")
    assert rows(typed) == [("000001", None), ("015009", 12.0)]


def test_append_batch_replay_and_schema_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    append_batch(a, path, "b1")
    append_batch(a, path, "b1")  # a retried batch replaces itself
    assert read_table(spark, path).count() == 2
    b = spark.createDataFrame([(3, "z", 1.5)], "id int, v string, extra double")
    append_batch(b, path, "b2")
    t = read_table(spark, path)
    assert "extra" in t.columns
    assert rows(t.drop(BATCH_COL)) == [(1, "x", None), (2, "y", None), (3, "z", 1.5)]


def test_overwrite_and_read_or_empty(spark, tmp_path):
    path = str(tmp_path / "g")
    overwrite(spark.range(5), path)
    overwrite(spark.range(3), path, single_file=True)
    assert read_table(spark, path).count() == 3
    assert len([f for f in os.listdir(current_folder(spark, path)) if f.endswith(".parquet")]) == 1
    empty = read_or_empty(spark, str(tmp_path / "missing"), "a string, b double")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def _touch(path: str, when: dt.datetime) -> None:
    ts = when.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(path, (ts, ts))


def test_changed_file_intake(spark, tmp_path):
    land = tmp_path / "landing"
    t0 = dt.datetime(2024, 5, 1, 12, 0, 0)
    names = list(TRANSACTION_FILES[:3]) + ["notes.csv"]
    for i, n in enumerate(names):
        p = fx.write_csv(str(land), n, ["a"], [[str(i)]])
        _touch(p, t0 + dt.timedelta(minutes=i))
    manifest_path = str(tmp_path / "manifest")

    listing = allow_listed(list_files(spark, str(land)))
    assert sorted(r.name for r in listing.collect()) == sorted(TRANSACTION_FILES[:3])

    # first run: no manifest yet -> every allowed file
    first = changed_files(listing, read_manifest(spark, manifest_path))
    assert first.count() == 3
    _commit(spark, first, manifest_path)

    # nothing changed -> nothing taken
    assert changed_files(allow_listed(list_files(spark, str(land))), read_manifest(spark, manifest_path)).count() == 0

    # one file rewritten under the same name, one new allowed file
    rewritten = os.path.join(str(land), TRANSACTION_FILES[0])
    fx.write_csv(str(land), TRANSACTION_FILES[0], ["a"], [["new"]])
    _touch(rewritten, t0 + dt.timedelta(hours=1))
    p = fx.write_csv(str(land), TRANSACTION_FILES[3], ["a"], [["9"]])
    _touch(p, t0 - dt.timedelta(days=1))  # older than every bookmark, but never seen
    again = changed_files(allow_listed(list_files(spark, str(land))), read_manifest(spark, manifest_path))
    assert sorted(r.name for r in again.collect()) == sorted([TRANSACTION_FILES[0], TRANSACTION_FILES[3]])
    _commit(spark, again, manifest_path)
    _commit(spark, again, manifest_path)  # replayed commit is harmless
    assert changed_files(allow_listed(list_files(spark, str(land))), read_manifest(spark, manifest_path)).count() == 0


def test_allow_listed_kind_and_trashed(spark):
    listing = spark.createDataFrame(
        [("NH_ProviderInfo_Oct2024.csv", "text/csv", False), ("NH_ProviderInfo_Oct2024.csv", "text/plain", False),
         ("NH_QualityMsr_MDS.csv", "text/csv", True), ("other.csv", "text/csv", False)],
        "name string, kind string, trashed boolean",
    )
    out = allow_listed(listing, kind_col="kind", trashed_col="trashed")
    assert rows(out) == [("NH_ProviderInfo_Oct2024.csv", "text/csv", False)]


def test_streaming_landing_takes_each_file_once(spark, tmp_path):
    land = str(tmp_path / "land")
    target = str(tmp_path / "silver")
    ckpt = str(tmp_path / "ckpt")
    schema = ", ".join(f"`{h}` string" for h in fx.FACILITY_HEADER)
    fx.write_csv(land, "f1.csv", fx.FACILITY_HEADER, fx.FACILITY_ROWS[:2])
    run_landing_once(spark, land, schema, target, silver.facility_performance, checkpoint=ckpt)
    assert read_table(spark, target).count() == 2
    fx.write_csv(land, "f2.csv", fx.FACILITY_HEADER, fx.FACILITY_ROWS[2:])
    run_landing_once(spark, land, schema, target, silver.facility_performance, checkpoint=ckpt)
    t = read_table(spark, target)
    assert t.count() == len(fx.FACILITY_ROWS)
    assert t.select(BATCH_COL).distinct().count() == 2
    assert dict(t.dtypes)["Performance_Period_FY_2022_Risk_Standardized_Readmission_Rate"] == "double"
    assert t.filter(F.col("CMS_Certification_Number_CCN") == "015012").first()[
        "Performance_Period_FY_2022_Risk_Standardized_Readmission_Rate"
    ] is None


def _commit(spark, changed, manifest_path):
    for r in changed.select("path", F.unix_micros("modified").alias("micros")).collect():
        record_file(spark, manifest_path, "", r.path, r.micros, batch_id_for("", r.path, r.micros))


def _facility_run(spark, land, manifest, target, run_id=None, job="facility"):
    return ingest_changed(spark, allow_listed(list_files(spark, land)), manifest, target, silver.facility_performance, run_id, job=job)


def test_ingest_changed_run(spark, tmp_path):
    land, manifest, target = (str(tmp_path / x) for x in ("raw", "manifest", "silver"))
    name = TRANSACTION_FILES[4]  # facility performance file
    p = fx.write_csv(land, name, fx.FACILITY_HEADER, fx.FACILITY_ROWS)
    _touch(p, dt.datetime(2024, 6, 1))
    assert _facility_run(spark, land, manifest, target) == 1
    assert _facility_run(spark, land, manifest, target) == 0  # nothing changed: no job beyond the listing
    fx.write_csv(land, name, fx.FACILITY_HEADER, fx.FACILITY_ROWS[:1])
    _touch(p, dt.datetime(2024, 7, 1))
    assert _facility_run(spark, land, manifest, target) == 1
    t = read_table(spark, target)
    assert t.count() == len(fx.FACILITY_ROWS) + 1
    assert t.select(BATCH_COL).distinct().count() == 2


def test_ingest_reused_run_id_replaces_nothing(spark, tmp_path):
    land, manifest, target = (str(tmp_path / x) for x in ("raw", "manifest", "silver"))
    _touch(fx.write_csv(land, TRANSACTION_FILES[0], fx.FACILITY_HEADER, fx.FACILITY_ROWS[:2]), dt.datetime(2024, 6, 1))
    assert _facility_run(spark, land, manifest, target, "2024-10") == 1
    _touch(fx.write_csv(land, TRANSACTION_FILES[1], fx.FACILITY_HEADER, fx.FACILITY_ROWS[2:3]), dt.datetime(2024, 6, 2))
    assert _facility_run(spark, land, manifest, target, "2024-10") == 1
    assert _facility_run(spark, land, manifest, target, "2024-10") == 0
    assert read_table(spark, target).count() == 3
    # another job with the same manifest keeps its own records
    assert _facility_run(spark, land, manifest, str(tmp_path / "other"), "2024-10", job="other") == 2
    assert _facility_run(spark, land, manifest, target, "2024-10") == 0


def test_ingest_crash_with_another_file_changed_before_the_rerun(spark, tmp_path):
    land, target = str(tmp_path / "raw"), str(tmp_path / "silver")
    _touch(fx.write_csv(land, TRANSACTION_FILES[0], fx.FACILITY_HEADER, fx.FACILITY_ROWS[:2]), dt.datetime(2024, 6, 1))
    # the first run "crashes" before its manifest counts
    assert _facility_run(spark, land, str(tmp_path / "lost"), target) == 1
    _touch(fx.write_csv(land, TRANSACTION_FILES[1], fx.FACILITY_HEADER, fx.FACILITY_ROWS[2:3]), dt.datetime(2024, 6, 2))
    assert _facility_run(spark, land, str(tmp_path / "manifest"), target) == 2
    t = read_table(spark, target)
    assert t.count() == 3 and t.select(BATCH_COL).distinct().count() == 2


def test_ingest_format_and_files_with_other_headers(spark, tmp_path):
    land, target = str(tmp_path / "raw"), str(tmp_path / "silver")
    header = fx.FACILITY_HEADER
    _touch(fx.write_csv(land, TRANSACTION_FILES[0], header, fx.FACILITY_ROWS[:1]), dt.datetime(2024, 6, 1))
    turned = [["extra", *reversed(fx.FACILITY_ROWS[1])]]
    _touch(fx.write_csv(land, TRANSACTION_FILES[1], ["Extra", *reversed(header)], turned), dt.datetime(2024, 6, 2))
    listing = allow_listed(list_files(spark, land))
    assert ingest_changed(spark, listing, str(tmp_path / "m"), target, silver.facility_performance, fmt="orc") == 2
    both = read_csv(spark, sorted(r.path for r in listing.collect()))
    got = {r["CMS Certification Number (CCN)"] for r in both.collect()}
    assert got == {fx.FACILITY_ROWS[0][header.index("CMS Certification Number (CCN)")], fx.FACILITY_ROWS[1][header.index("CMS Certification Number (CCN)")]}
    stored = spark.read.option("mergeSchema", True).orc(target)
    assert {r.CMS_Certification_Number_CCN for r in stored.collect()} == got
    assert "Extra" in stored.columns


def test_manifest_folder_without_data_files_is_empty(spark, tmp_path):
    (tmp_path / "manifest").mkdir()
    assert read_manifest(spark, str(tmp_path / "manifest")).count() == 0


def test_landing_from_another_checkpoint_replaces_nothing(spark, tmp_path):
    target, schema = str(tmp_path / "silver"), ", ".join(f"`{h}` string" for h in fx.FACILITY_HEADER)
    for k, part in enumerate((fx.FACILITY_ROWS[:2], fx.FACILITY_ROWS[2:3])):
        fx.write_csv(str(tmp_path / f"land{k}"), "f.csv", fx.FACILITY_HEADER, part)
        run_landing_once(spark, str(tmp_path / f"land{k}"), schema, target, silver.facility_performance, checkpoint=str(tmp_path / f"ckpt{k}"))
    assert read_table(spark, target).count() == 3
    with pytest.raises(ValueError):
        run_landing_once(spark, str(tmp_path / "land0"), schema, target, silver.facility_performance, checkpoint="")


def test_shared_folder_is_needed_off_local_mode():
    from wardstat.session import _local_folder

    assert _local_folder("local[2]")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            _local_folder(master)


def test_batch_id_for_is_one_file_version():
    a = batch_id_for("j", "/l/a.csv", 1)
    assert a == batch_id_for("j", "/l/a.csv", 1)
    assert len({a, batch_id_for("k", "/l/a.csv", 1), batch_id_for("j", "/l/b.csv", 1), batch_id_for("j", "/l/a.csv", 2)}) == 4
