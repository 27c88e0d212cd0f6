"""Physical-plan properties the scale design relies on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from wardstat.operators.dedup import latest_per_key
from wardstat.plans import gold, jobs
from wardstat.plans import standins as S


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_latest_per_key_limits_before_the_shuffle(spark, capsys):
    plan = plan_of(S.q_latest_per_key(spark, SF_SMALL), capsys)
    head = plan.split("\n\n")[0]
    # partial limit below the exchange, final limit above it
    assert head.count("WindowGroupLimit") == 2
    assert head.index("Exchange") < head.rindex("WindowGroupLimit")


def test_hot_key_third_of_rows(spark):
    t0 = dt.datetime(2024, 1, 1)
    hot = [("HOT", t0 + dt.timedelta(seconds=i), i, float(i)) for i in range(3000)]
    cold = [(f"K{i % 2000}", t0 + dt.timedelta(seconds=i), 10_000 + i, 1.0) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "ccn string, stamp timestamp, seq long, v double").repartition(16)
    out = latest_per_key(df, "ccn", stamp="stamp", tie_break="seq")
    assert out.count() == 2001
    assert out.filter(F.col("ccn") == "HOT").first().seq == 2999


def test_latest_picks_share_the_join_partitioning(spark, capsys, no_broadcast):
    prov = spark.createDataFrame(
        [("1", dt.datetime(2024, 1, 1), "100"), ("1", dt.datetime(2024, 2, 1), "120"), ("2", dt.datetime(2024, 1, 1), "50")],
        f"{gold.CCN} string, {gold.STAMP} timestamp, {gold.BEDS} string",
    )
    sk = spark.createDataFrame(
        [("1", dt.datetime(2024, 1, 1), gold.THROUGHPUT_MEASURE, "60"), ("2", dt.datetime(2024, 1, 1), gold.THROUGHPUT_MEASURE, "10")],
        f"{gold.CCN} string, {gold.STAMP} timestamp, Measure_Code string, Score string",
    )
    t = gold.patient_throughput(prov, sk)
    head = plan_of(t, capsys).split("\n\n")[0]
    assert "SortMergeJoin" in head
    # one shuffle per latest-record pick; the join reuses that partitioning
    assert head.count("Exchange") == 2
    got = {r[gold.CCN]: r[gold.THROUGHPUT] for r in t.collect()}
    assert got == {"1": 0.5, "2": 0.2}


def test_band_filter_reaches_the_scan(spark, capsys):
    plan = plan_of(S.q_staffing_band_detail(spark, SF_SMALL), capsys)
    assert "GreaterThan(l_quantity,1.0)" in plan and "LessThan(l_quantity,15.0)" in plan
    # only the needed lineitem columns are read
    li_scan = [blk for blk in plan.split("\n\n") if "lineitem.parquet" in blk][0]
    assert "l_comment" not in li_scan and "l_shipdate" not in li_scan


def _broadcast_scans(plan: str) -> list[str]:
    """Scan blocks under every BroadcastExchange of a formatted plan."""
    blocks = plan.split("\n\n")
    tree = blocks[0].split("\n")
    found = []
    for i, line in enumerate(tree):
        if "BroadcastExchange" not in line:
            continue
        depth = line.index("BroadcastExchange")
        sub = [ln for ln in tree[i + 1:]]
        below = []
        for ln in sub:
            name_at = len(ln) - len(ln.lstrip(" :+-|"))
            if name_at <= depth:
                break
            below.append(ln)
        ids = [tok.strip("()") for ln in below for tok in ln.split() if tok.startswith("(")]
        found += [b for b in blocks if any(b.startswith(f"({n}) Scan") for n in ids)]
    return found


def test_fact_is_never_the_broadcast_side(spark, capsys):
    for name in ("silver_master", "staffing_band_detail", "bed_utilization_by_hospital", "onduty_hours_by_state_day"):
        scans = _broadcast_scans(plan_of(entry.queries()[name](spark, SF_SMALL), capsys))
        assert scans, name
        assert not any("lineitem.parquet" in b or "orders.parquet" in b for b in scans), name


def test_grouping_sets_job_shuffles_small_sets_once_and_the_pair_set_alone(spark, capsys):
    r = jobs.staffing_rollups(S.staffing_silver(spark, SF_SMALL))
    head = plan_of(r, capsys).split("\n\n")[0]
    assert "Expand" in head
    shuffles = [ln for ln in head.split("\n") if "Exchange" in ln and "Broadcast" not in ln]
    # the three small sets share an Expand and a shuffle; the near-unique pair set has its own
    assert len(shuffles) == 2
    assert len([ln for ln in head.split("\n") if "Expand" in ln]) == 1


def test_bed_plans_count_the_many_row_side_before_the_join(spark, capsys, tmp_path):
    """A facility with a third of all MDS rows is reduced inside the map
    tasks: after the latest pick no join task gets its rows."""
    mds = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("CCN"), (F.col("id") % 4).cast("string").alias("kind")
    )
    mds.repartition(6).write.parquet(str(tmp_path / "mds"))
    mds = spark.read.parquet(str(tmp_path / "mds"))
    prov = spark.range(500).select(
        F.col("id").alias("CCN"), F.lit(5.0).alias("residents"), F.lit(10.0).alias("beds"), F.lit("2024-10-01").cast("timestamp").alias("loaded")
    )
    plain = gold.bed_utilization(prov, mds, ["kind"], "u", key="CCN", residents="residents", beds="beds", stamp="loaded")
    rolled = jobs.bed_utilization_rollups(prov, mds, key="CCN", residents="residents", beds="beds", stamp="loaded", sets={"k": ("kind",)})
    for df in (plain, rolled):
        tree = plan_of(df, capsys).split("\n\n")[0].split("\n")
        scan = next(i for i, ln in enumerate(tree) if "Scan parquet" in ln)
        above = [ln for ln in tree[:scan] if any(k in ln for k in ("HashAggregate", "Exchange", "Join"))]
        names = [next(k for k in ("HashAggregate", "Exchange", "Join") if k in ln) for ln in above]
        # from the scan upwards: counted, then shuffled
        assert names[-1] == "HashAggregate" and names[-2] == "Exchange", tree
    assert [tuple(r) for r in plain.orderBy("kind").collect()] == [(str(k), 50.0) for k in range(4)]
    counts = gold.mds_counts(prov, mds, "CCN", ["kind"])
    assert counts.groupBy("CCN").count().agg(F.max("count")).first()[0] <= 4  # rows of the hot key that meet the join
