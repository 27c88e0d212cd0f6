"""Raw CSV -> silver -> gold -> serving on small CMS-shaped files."""

import math
import time

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tests.conftest import rows
from wardstat.plans import checks, gold, serving, silver
from wardstat.sources.files import read_csv, read_table
from wardstat.sources.sinks import append_batch


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cms")
    raw = str(root / "raw")
    out = {}
    out["master"] = silver.master_staffing(read_csv(spark, fx.write_csv(raw, "master.csv", fx.MASTER_HEADER, fx.MASTER_ROWS)))
    prov_path = str(root / "silver_provider")
    p1 = fx.write_csv(raw + "/p1", "NH_ProviderInfo_Oct2024.csv", fx.PROVIDER_HEADER, fx.PROVIDER_LOAD_1)
    p2 = fx.write_csv(raw + "/p2", "NH_ProviderInfo_Oct2024.csv", fx.PROVIDER_HEADER, fx.PROVIDER_LOAD_2)
    append_batch(silver.provider_info(read_csv(spark, p1)), prov_path, "load-1")
    time.sleep(0.05)
    append_batch(silver.provider_info(read_csv(spark, p2)), prov_path, "load-2")
    out["provider"] = read_table(spark, prov_path)
    out["skilled"] = silver.skilled_nursing(read_csv(spark, fx.write_csv(raw, "skilled.csv", fx.SKILLED_HEADER, fx.SKILLED_ROWS)))
    out["facility"] = silver.facility_performance(
        read_csv(spark, fx.write_csv(raw, "facility.csv", fx.FACILITY_HEADER, fx.FACILITY_ROWS))
    )
    out["mds"] = silver.quality_mds(read_csv(spark, fx.write_csv(raw, "mds.csv", fx.MDS_HEADER, fx.MDS_ROWS)))
    return out


def test_master_staffing_silver(layers):
    m = layers["master"]
    got = {(r.PROVNUM, str(r.WorkDate)): r for r in m.collect()}
    assert set(got) == {("015009", "2024-04-01"), ("015009", "2024-04-02"), ("015010", "2024-04-01"), ("015010", "None"), ("", "2024-04-01")}
    first = got[("015009", "2024-04-01")]
    assert first.STATE == "AL" and first.Hrs_RNDON == 8.0  # survivor: first under the total order
    assert first.TotalNursing_Hours == 35.0 and first.TotalAdminNursing_Hours == 3.0
    assert (first.RN_Ratio, first.CNA_Ratio, first.LPN_Ratio) == (0.2, 0.4, 0.1)
    second = got[("015009", "2024-04-02")]
    assert second.TotalNursing_Hours == 5.0 and second.RN_Ratio == 0.0  # census 0 -> 0
    assert got[("015010", "2024-04-01")].STATE == "NY" and got[("015010", "2024-04-01")].CNA_Ratio == 0.0
    assert got[("015010", "None")].RN_Ratio == 0.4  # date did not parse: NULL, no error


def test_master_staffing_options(spark, layers, tmp_path):
    raw = read_csv(spark, fx.write_csv(str(tmp_path), "m.csv", fx.MASTER_HEADER, fx.MASTER_ROWS))
    strict = silver.master_staffing(raw, blank_is_null=True)
    assert "" not in {r.PROVNUM for r in strict.collect()}
    extra = fx.MASTER_ROWS + [["015010", "Beta Care", "ny", "April 3", "1", "1", "1", "1", "", "", "10"]]
    raw2 = read_csv(spark, fx.write_csv(str(tmp_path / "b"), "m.csv", fx.MASTER_HEADER, extra))
    assert silver.master_staffing(raw2).filter(F.col("WorkDate").isNull()).count() == 1
    assert silver.master_staffing(raw2, dedup_null_dates=False).filter(F.col("WorkDate").isNull()).count() == 2


def test_staffing_checks(layers):
    got = dict((r.check_name, r.n) for r in checks.staffing_checks(layers["master"]).collect())
    assert got == {"row_count": 5, "null_key": 0, "untrimmed": 0, "duplicate_key": 0, "unparsed_work_date": 1}
    pv = checks.preview(layers["master"], n=2).collect()
    assert len(pv) == 2 and pv[0].PROVNUM == ""
    assert ("WorkDate", "date") in checks.schema_of(layers["master"])


def test_transaction_silver_shapes(layers):
    p = layers["provider"]
    assert "CMS_Certification_Number_CCN" in p.columns and "City/Town" in p.columns
    assert dict(p.dtypes)["Number_of_Certified_Beds"] == "double"
    assert dict(p.dtypes)[silver.STAMP] == "timestamp"
    f = layers["facility"]
    assert "Performance_Period_FY_2022_Risk_Standardized_Readmission_Rate" in f.columns
    s = {r.CMS_Certification_Number_CCN: r.Score for r in layers["skilled"].filter("Measure_Code = 'S_005_02_DTC_VOLUME'").collect()}
    assert s["015010"] == 0.0 and s["015009"] == 60.0


def test_patient_throughput_latest_load(layers):
    t = gold.patient_throughput(layers["provider"], layers["skilled"])
    got = {r.CMS_Certification_Number_CCN: r for r in t.collect()}
    assert set(got) == {"015009", "015010", "015012"}
    assert got["015009"].Number_of_Certified_Beds == 120.0  # the newer load
    assert got["015009"].Patient_Throughput == 0.5
    assert got["015010"].Patient_Throughput is None  # zero beds -> NULL, no error
    # two rows of one load share a stamp: the tie-break (remaining columns,
    # descending) keeps the same one on every run
    assert got["015012"].Score == 30.0 and got["015012"].Patient_Throughput == 0.6
    top = serving.top_throughput(t, 10, columns=["CMS_Certification_Number_CCN", "Patient_Throughput"]).collect()
    assert [r[0] for r in top] == ["015012", "015009"]


def test_bed_utilization(layers):
    by_h = gold.bed_utilization(layers["provider"], layers["mds"], ["Provider_Name", "State"], "Bed_Utilization_By_Hospital")
    assert rows(by_h) == [("Alpha Home", "AL", 75.0), ("Beta Care", "NY", None), ("Delta Place", "TX", None)]
    by_d = gold.bed_utilization(layers["provider"], layers["mds"], ["Resident_type"], "Bed_Utilization_By_Department")
    assert rows(by_d) == [("Long Stay", 75.0), ("Short Stay", 75.0)]
    pick = serving.selected_hospitals(by_h, ["Alpha Home", "Beta Care"], state="NY").collect()
    assert [r.Provider_Name for r in pick] == ["Beta Care"]
    assert sorted(r.Provider_Name for r in serving.hospitals_in_state(by_h, "AL").collect()) == ["Alpha Home"]


def _pearson(pairs):
    n = len(pairs)
    mx = sum(p[0] for p in pairs) / n
    my = sum(p[1] for p in pairs) / n
    sxy = sum((a - mx) * (b - my) for a, b in pairs)
    sxx = sum((a - mx) ** 2 for a, _ in pairs)
    syy = sum((b - my) ** 2 for _, b in pairs)
    return sxy / math.sqrt(sxx * syy)


def test_staffing_readmission_modes(layers):
    detail, summary = gold.staffing_readmission(layers["provider"], layers["facility"])
    got = {r.CMS_Certification_Number_CCN: (r[gold.STAFF_HOURS], r[gold.READMISSION]) for r in detail.collect()}
    # hours exactly 1 or 15 and unparsable hours fall outside the band
    assert got == {"015009": (5.5, 20.5), "015013": (3.0, 18.0), "015014": (8.0, 25.0), "015015": (6.0, 0.0)}
    r_zero = summary.first()[gold.CORRELATION]
    assert r_zero == pytest.approx(_pearson(list(got.values())))
    _, dropped = gold.staffing_readmission(layers["provider"], layers["facility"], missing="drop", count_name="n")
    row = dropped.first()
    assert row.n == 4
    assert row[gold.CORRELATION] == pytest.approx(_pearson([v for k, v in got.items() if k != "015015"]))
    kpi = serving.facility_kpis(detail, "NY").first()
    assert (kpi.facilities, kpi.avg_hours) == (2, 7.0)
    fit = serving.trend_line(detail, gold.READMISSION, gold.STAFF_HOURS).first()
    assert fit.n == 4


def test_staffing_gold(layers):
    m = layers["master"]
    hours = gold.onduty_hours(m)
    assert rows(hours.filter("STATE = 'AL'").select("WorkDate", "Total_RN_Hours").withColumn("WorkDate", F.col("WorkDate").cast("string"))) == [
        ("2024-04-01", 8.0), ("2024-04-02", 7.0)
    ]
    assert serving.total_hours(hours).first()[0] == 8.0 + 7.0 + 6.0 + 6.0 + 1.0
    by_state = {r.STATE: r.Avg_Nurse_Ratio_ByState for r in gold.nurse_ratio(m, ["STATE"], "Avg_Nurse_Ratio_ByState").collect()}
    # AL: 35/50 and 5/0 (NULL, skipped); NY: 12/NULL (skipped) and 12/10
    assert by_state["AL"] == pytest.approx(0.7) and by_state["NY"] == pytest.approx(1.2)
    assert serving.total_hours(m.drop("Hrs_RNDON").limit(0), column="Total_RN_Hours").first()[0] == 0.0
    assert [r.PROVNAME for r in serving.default_selection(m, "PROVNAME", 1).collect()] == ["Alpha Home", "Alpha Home"]


def test_hours_series_and_scale_conf(layers):
    from wardstat.session import scale_conf

    series = serving.hours_series(gold.onduty_hours(layers["master"])).collect()
    keys = [(str(r.WorkDate), r.STATE) for r in series]
    assert keys == sorted(keys, key=lambda k: (k[0] != "None", k))
    conf = scale_conf(100 * 2**40, 4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 50_000  # beyond it reducers get more each
    assert int(conf["spark.sql.files.maxPartitionBytes"]) * 50_000 >= 100 * 2**40
    assert int(scale_conf(2**40, 100)["spark.sql.shuffle.partitions"]) == 4096
    assert int(scale_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16


def test_master_staffing_header_case(spark, tmp_path):
    header = [h.lower() if h == "WorkDate" else h for h in fx.MASTER_HEADER]
    raw = read_csv(spark, fx.write_csv(str(tmp_path), "m.csv", header, fx.MASTER_ROWS))
    assert silver.master_staffing(raw).count() == 5


def test_job_runner_end_to_end(spark, tmp_path):
    from wardstat.plans.runner import run

    raw = str(tmp_path / "raw")
    out = str(tmp_path / "lake")
    m = fx.write_csv(raw + "/master", "PBJ.csv", fx.MASTER_HEADER, fx.MASTER_ROWS)
    assert run(["silver-master", "--raw", m, "--out", out + "/silver/master"], spark)["written"]
    assert run(["checks", "--silver", out + "/silver/master"], spark)["checks"]["duplicate_key"] == 0
    run(["gold-staffing", "--silver", out + "/silver/master", "--out", out + "/gold/staffing"], spark)
    by_state = read_table(spark, out + "/gold/staffing").filter("summary = 'ratio_by_state'")
    assert {r.STATE for r in by_state.collect()} == {"AL", "NY", "TX"}

    land = raw + "/landing"
    fx.write_csv(land, "NH_ProviderInfo_Oct2024.csv", fx.PROVIDER_HEADER, fx.PROVIDER_LOAD_1)
    fx.write_csv(land, "FY_2024_SNF_VBP_Facility_Performance.csv", fx.FACILITY_HEADER, fx.FACILITY_ROWS)
    fx.write_csv(land, "PBJ_Daily_Nurse_Staffing_Q2_2024.csv", fx.MASTER_HEADER, fx.MASTER_ROWS)
    args = ["intake", "--landing", land, "--manifest", out + "/manifest", "--out", out + "/silver/provider",
            "--job-name", "silver-provider", "--batch", "2024-10"]
    assert run(args, spark)["files"] == 1  # only the provider file, not the facility file
    assert run(args, spark)["files"] == 0  # nothing changed since
    master_args = ["intake", "--landing", land, "--manifest", out + "/manifest", "--out", out + "/silver/master2",
                   "--job-name", "silver-master", "--batch", "2024-q2"]
    assert run(master_args, spark)["files"] == 1
    assert read_table(spark, out + "/silver/master2").count() == 5
    tx = run(["checks", "--silver", out + "/silver/provider", "--table", "transaction"], spark)["checks"]
    assert tx["null_key"] == 0 and tx["duplicate_key"] == 0
    sk = fx.write_csv(raw + "/sk", "skilled.csv", fx.SKILLED_HEADER, fx.SKILLED_ROWS)
    run(["silver-skilled", "--raw", sk, "--out", out + "/silver/skilled", "--batch", "2024-10"], spark)
    fac = fx.write_csv(raw + "/fac", "fac.csv", fx.FACILITY_HEADER, fx.FACILITY_ROWS)
    run(["silver-facility", "--raw", fac, "--out", out + "/silver/facility", "--batch", "2024-10"], spark)
    mds = fx.write_csv(raw + "/mds", "mds.csv", fx.MDS_HEADER, fx.MDS_ROWS)
    run(["silver-mds", "--raw", mds, "--out", out + "/silver/mds", "--batch", "2024-10"], spark)
    run(["gold-throughput", "--provider", out + "/silver/provider", "--skilled", out + "/silver/skilled",
         "--out", out + "/gold/throughput"], spark)
    assert read_table(spark, out + "/gold/throughput").count() == 3
    run(["gold-bed", "--provider", out + "/silver/provider", "--mds", out + "/silver/mds", "--out", out + "/gold/bed"], spark)
    dept = read_table(spark, out + "/gold/bed").filter("summary = 'utilization_by_department'")
    assert rows(dept.select("Resident_type", "Bed_Utilization")) == [("Long Stay", 80.0), ("Short Stay", 80.0)]
    res = run(["gold-readmission", "--provider", out + "/silver/provider", "--facility", out + "/silver/facility",
               "--out", out + "/gold/readmission"], spark)
    summary = read_table(spark, res["written"][1])
    assert summary.count() == 1 and summary.first()[0] is not None


def test_rollup_jobs_equal_single_outputs(layers):
    from wardstat.plans import jobs

    m = layers["master"]
    r = jobs.staffing_rollups(m)
    part = jobs.summary_part(r, "onduty_hours_summary", jobs.STAFFING_SETS)
    assert rows(part.select("STATE", "WorkDate", gold.TOTAL_RN_HOURS)) == rows(gold.onduty_hours(m))
    for name, keys in jobs.STAFFING_SETS.items():
        if name == "onduty_hours_summary":
            continue
        part = jobs.summary_part(r, name, jobs.STAFFING_SETS).select(*keys, "Avg_Nurse_Ratio")
        assert rows(part) == rows(gold.nurse_ratio(m, list(keys), "x")), name
    b = jobs.bed_utilization_rollups(layers["provider"], layers["mds"])
    for name, keys in jobs.BED_SETS.items():
        part = jobs.summary_part(b, name, jobs.BED_SETS).select(*keys, "Bed_Utilization")
        assert rows(part) == rows(gold.bed_utilization(layers["provider"], layers["mds"], list(keys), "x")), name


def test_bed_utilization_pre_aggregate_equals_row_mean(layers, capsys):
    for by in (["Provider_Name", "State"], ["Resident_type"]):
        plain = gold.bed_utilization(layers["provider"], layers["mds"], by, "u")
        pre = gold.bed_utilization(layers["provider"], layers["mds"], by, "u", pre_aggregate=True)
        assert rows(pre) == rows(plain), by
    with pytest.raises(ValueError):
        gold.bed_utilization(layers["provider"], layers["mds"], ["Resident_type"], "u",
                             residents="Measure_Code", pre_aggregate=True)


def test_gold_tables_layout(spark, layers, tmp_path):
    from wardstat.plans.runner import run

    silver_path = str(tmp_path / "silver")
    layers["master"].write.parquet(silver_path)
    out = run(["gold-staffing", "--silver", silver_path, "--out", str(tmp_path / "gold"), "--layout", "tables"], spark)
    written = out["written"]
    assert set(written) == {"onduty_hours_summary", "ratio_by_hospital", "ratio_by_state", "ratio_by_department"}
    by_state = read_table(spark, written["ratio_by_state"])
    assert by_state.columns == ["STATE", "Avg_Nurse_Ratio_ByState"]
    want = gold.nurse_ratio(layers["master"], ["STATE"], "Avg_Nurse_Ratio_ByState")
    assert rows(by_state) == rows(want)
    hours = read_table(spark, written["onduty_hours_summary"])
    assert hours.columns == ["STATE", "WorkDate", "Total_RN_Hours"]


def test_report_jobs(spark, layers, tmp_path):
    from wardstat.plans.runner import run

    t = gold.patient_throughput(layers["provider"], layers["skilled"])
    t_path = str(tmp_path / "throughput")
    t.write.parquet(t_path)
    top = run(["report-top-throughput", "--gold", t_path, "--n", "2"], spark)["rows"]
    assert [r["CMS_Certification_Number_CCN"] for r in top] == ["015012", "015009"]
    detail, _ = gold.staffing_readmission(layers["provider"], layers["facility"])
    d_path = str(tmp_path / "detail")
    detail.write.parquet(d_path)
    kpi = run(["report-kpis", "--gold", d_path, "--state", "NY"], spark)["rows"][0]
    assert (kpi["facilities"], kpi["avg_hours"]) == (2, 7.0) and kpi["correlation"] is not None
    assert run(["report-trend", "--gold", d_path], spark)["rows"][0]["n"] == 4
    assert [r["State"] for r in run(["report-states", "--gold", d_path], spark)["rows"]] == ["AL", "NY"]


def test_fixed_stamp_makes_replays_identical(spark, tmp_path):
    raw = read_csv(spark, fx.write_csv(str(tmp_path), "f.csv", fx.FACILITY_HEADER, fx.FACILITY_ROWS))
    a = silver.facility_performance(raw, stamp="2024-10-01 00:00:00")
    b = silver.facility_performance(raw, stamp="2024-10-01 00:00:00")
    assert rows(a) == rows(b)
    assert {str(r[silver.STAMP]) for r in a.collect()} == {"2024-10-01 00:00:00"}
    assert silver.STAMP not in silver.facility_performance(raw, stamp=False).columns


def test_transaction_checks(layers):
    got = {r.check_name: r.n for r in checks.transaction_checks(layers["skilled"], extra_key=("Measure_Code",)).collect()}
    # 015012 appears twice for the same measure in one load
    assert got == {"row_count": len(fx.SKILLED_ROWS), "null_key": 0, "duplicate_key": 1}


def test_jobs_and_reports_in_orc(spark, tmp_path):
    """Every job writes and reads the asked format, and every page has rows."""
    from wardstat.plans.runner import run as run_job

    raw, out = str(tmp_path / "raw"), str(tmp_path / "lake")
    run = lambda *a: run_job([*a, "--format", "orc"], spark)
    master = fx.write_csv(raw + "/master", "PBJ.csv", fx.MASTER_HEADER, fx.MASTER_ROWS)
    assert run("silver-master", "--raw", master, "--out", out + "/master")["undated_rows"] == 1
    land = raw + "/landing"
    files = {"provider": ("NH_ProviderInfo_Oct2024.csv", fx.PROVIDER_HEADER, fx.PROVIDER_LOAD_1),
             "facility": ("FY_2024_SNF_VBP_Facility_Performance.csv", fx.FACILITY_HEADER, fx.FACILITY_ROWS),
             "mds": ("NH_QualityMsr_MDS.csv", fx.MDS_HEADER, fx.MDS_ROWS)}
    for job, (name, header, body) in files.items():
        fx.write_csv(land, name, header, body)
        took = run("intake", "--landing", land, "--manifest", out + "/manifest", "--out", f"{out}/{job}", "--job-name", f"silver-{job}")
        assert took["files"] == 1
    sk = fx.write_csv(raw + "/sk", "skilled.csv", fx.SKILLED_HEADER, fx.SKILLED_ROWS)
    run("silver-skilled", "--raw", sk, "--out", out + "/skilled", "--batch", "b1")
    run("gold-staffing", "--silver", out + "/master", "--out", out + "/g/staffing")
    run("gold-staffing", "--silver", out + "/master", "--out", out + "/g/tables", "--layout", "tables")
    run("gold-bed", "--provider", out + "/provider", "--mds", out + "/mds", "--out", out + "/g/bed")
    run("gold-throughput", "--provider", out + "/provider", "--skilled", out + "/skilled", "--out", out + "/g/throughput")
    detail, summary = run("gold-readmission", "--provider", out + "/provider", "--facility", out + "/facility", "--out", out + "/g/readmission")["written"]
    assert spark.read.orc(out + "/provider").count() == len(fx.PROVIDER_LOAD_1)
    assert read_table(spark, summary, "orc").count() == 1
    got = run("checks", "--silver", out + "/master", "--n", "2")
    assert len(got["preview"]) == 2 and ("WorkDate", "date") in got["schema"]

    silver_hours = read_table(spark, out + "/master", "orc").agg(F.sum("Hrs_RNDON")).first()[0]
    for path in ("/g/staffing", "/g/tables/onduty_hours_summary"):
        assert run("report-total-hours", "--gold", out + path)["rows"][0][gold.TOTAL_RN_HOURS] == silver_hours
        assert len(run("report-hours-series", "--gold", out + path)["rows"]) == 5
    assert len(run("report-hospitals", "--gold", out + "/g/staffing", "--names", "Alpha Home")["rows"]) == 1
    for job, path in (("ratio-states", "staffing"), ("departments", "staffing"), ("bed-departments", "bed"),
                      ("bed-hospitals", "bed"), ("top-throughput", "throughput")):
        assert run(f"report-{job}", "--gold", f"{out}/g/{path}")["rows"], job
    kpi = run("report-kpis", "--gold", detail, "--summary", summary)["rows"][0]
    assert kpi["correlation"] == read_table(spark, summary, "orc").first()[0]
    assert run("report-scatter", "--gold", detail, "--out", out + "/points")["written"]
    assert read_table(spark, out + "/points", "orc").count() == read_table(spark, detail, "orc").count()
    # pages whose tables are not there yet
    assert run("report-hours-series", "--gold", out + "/none")["rows"] == []
    assert run("report-kpis", "--gold", out + "/none", "--summary", out + "/none2")["rows"][0]["facilities"] == 0


def test_master_options_and_append_rules(spark, tmp_path):
    from wardstat.plans.runner import run

    extra = fx.MASTER_ROWS + [["015010", "Beta Care", "ny", "April 3", "1", "1", "1", "1", "", "", "10"]]
    raw = fx.write_csv(str(tmp_path), "m.csv", fx.MASTER_HEADER, extra)
    args = ["silver-master", "--raw", raw, "--out", str(tmp_path / "t")]
    kept = run(args, spark)
    assert kept["undated_rows"] == 2 and read_table(spark, kept["written"]).filter("WorkDate is null").count() == 2
    run([*args, "--undated", "collapse"], spark)
    assert read_table(spark, kept["written"]).filter("WorkDate is null").count() == 1
    with pytest.raises(SystemExit):
        run([*args, "--undated", "fail"], spark)
    with pytest.raises(SystemExit):  # an append needs the name of its load
        run(["silver-mds", "--raw", raw, "--out", str(tmp_path / "x")], spark)


def test_master_intake_rebuilds_from_all_files(spark, tmp_path):
    import os

    from wardstat.sources.intake import MASTER_FILE
    from wardstat.plans.runner import run

    land = tmp_path / "landing"
    day = lambda k: [["015009", "Alpha", "al", f"2024-04-0{k}", "1", "1", "1", "1", "", "", "10"]]
    names = [MASTER_FILE, "second.csv"]
    for k, name in enumerate(names, 1):
        fx.write_csv(str(land), name, fx.MASTER_HEADER, day(k))
    args = ["intake", "--landing", str(land), "--manifest", str(tmp_path / "m"), "--out", str(tmp_path / "t"),
            "--job-name", "silver-master", "--names", ",".join(names)]
    assert run(args, spark)["files"] == 2
    assert run(args, spark)["files"] == 0
    os.utime(land / "second.csv", (2_000_000_000, 2_000_000_000))
    assert run(args, spark)["files"] == 1  # one file changed, and the other one's rows stay
    assert read_table(spark, str(tmp_path / "t")).count() == 2


def test_untrimmed_sees_every_white_space(spark):
    from wardstat.operators.quality import quality_counts

    values = ["NY", "\tNY", "NY\n", "\u00a0NY", "NY\u2003", " NY", None, "N Y", "\x1cNY", ""]
    df = spark.createDataFrame([(v,) for v in values], "STATE string")
    want = sum(v is None or v != v.strip() for v in values)
    assert quality_counts(df, trimmed=["STATE"], row_count=False).first().n == want


def test_failed_overwrite_leaves_the_table(spark, tmp_path):
    from wardstat.sources.sinks import overwrite

    path = str(tmp_path / "t")
    overwrite(spark.range(5), path)
    overwrite(read_table(spark, path).filter("id > 1"), path)  # also from itself
    assert read_table(spark, path).count() == 3
    with pytest.raises(Exception, match="no luck"):
        overwrite(spark.range(9).withColumn("x", F.raise_error(F.lit("no luck"))), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [2, 3, 4]


def test_stored_schema_has_every_column(spark, tmp_path):
    path = str(tmp_path / "t")
    append_batch(spark.createDataFrame([(1, "a")], "id int, v string"), path, "b1", fmt="orc")
    append_batch(spark.createDataFrame([(2.5, 2)], "extra double, id int"), path, "b2", fmt="orc")
    t = read_table(spark, path, "orc")
    assert t.columns == ["id", "v", "extra", "batch_id"]
    assert rows(t.select("id", "v", "extra")) == [(1, "a", None), (2, None, 2.5)]
