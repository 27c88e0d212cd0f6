"""Joins with hot and NULL keys, and the binned scatter."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardstat.operators.dedup import latest_per_key
from wardstat.operators.joins import HOT_SHARE, hot_keys, join_keep_left, key_hash, spread_buckets
from wardstat.plans import serving


@pytest.fixture
def plain(spark):
    """Sort-merge joins in eight partitions that nothing splits or merges."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_part(df):
    """The share of the rows that the fullest partition holds."""
    n = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(n) / sum(n)


def facts(spark, n=9000):
    """A third of the rows at one key."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"))


def loads(spark):
    """Three stamped rows of every key."""
    keys = spark.range(700).select(F.concat(F.lit("k"), "id").alias("k")).union(spark.createDataFrame([("hot",)], "k string"))
    days = spark.range(3).select(F.timestamp_seconds(F.col("id") * 86400).alias("stamp"), F.col("id").alias("v"))
    return keys.crossJoin(days)


def test_hot_keys_are_found(spark):
    found = hot_keys(facts(spark), "k")
    wanted = spark.createDataFrame([("hot",)], "k string").select(key_hash(["k"])).first()[0]
    assert set(found) == {wanted} and abs(found[wanted] - 1 / 3) < 0.001
    assert hot_keys(facts(spark).limit(0), "k") == {} and hot_keys(spark.range(3000), "id") == {}
    two = spark.range(1000).selectExpr("id % 2 as a", "cast(null as string) as b")
    assert sorted(hot_keys(two, ["a", "b"]).values()) == [0.5, 0.5]
    many = spark.range(100_000).selectExpr("if(id % 10 < 4, id % 40, id) as k")  # 16 keys of 1%
    assert len([s for s in hot_keys(many, "k").values() if s >= HOT_SHARE]) == 16


@pytest.mark.parametrize("how,skewed", [("inner", "right"), ("inner", "left"), ("left", "left")])
def test_a_third_of_the_rows_on_one_key_after_a_latest_pick(spark, plain, how, skewed):
    latest, fact = latest_per_key(loads(spark), "k", stamp="stamp", tie_break="v"), facts(spark)
    left, right = (latest, fact) if skewed == "right" else (fact, latest)
    keep = ["id"] if skewed == "right" else ["v"]
    straight = join_keep_left(left, right, "k", keep=keep, how=how)
    spread = join_keep_left(left, right, "k", keep=keep, how=how, hot="auto", skewed=skewed)
    assert rows(spread.select("k", "id", "v")) == rows(straight.select("k", "id", "v"))
    assert largest_part(straight) > 0.33 and largest_part(spread) < 0.15
    assert spread.columns == straight.columns


def test_no_hot_key_no_second_plan(spark):
    a, b = spark.range(3000).withColumn("v", F.lit(1)), spark.range(3000).withColumn("w", F.lit(2))
    plan = join_keep_left(a, b, "id", hot="auto")._jdf.queryExecution().toString()
    assert "salt" not in plan
    assert spread_buckets({1: 0.5}, 200) == 400 and spread_buckets({}, 200, nulls=True) == 16


def test_joins_that_cannot_be_spread(spark):
    a, b = facts(spark, 300), facts(spark, 300).withColumnRenamed("id", "w")
    for how, skewed in (("left", "right"), ("full", "left"), ("left_anti", "left")):
        with pytest.raises(ValueError):
            join_keep_left(a, b, "k", how=how, hot="auto", skewed=skewed)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_null_keys_match_each_other(spark, how):
    rng = random.Random(4)
    some = lambda n, name: [(rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"]), f"{name}{i}") for i in range(n)]
    left, right = some(60, "l"), some(25, "r")
    a, b = spark.createDataFrame(left, "k long, j string, v string"), spark.createDataFrame(right, "k long, j string, w string")
    got = rows(join_keep_left(a, b, ["k", "j"], how=how, null_safe=True, skewed="left"))
    want = [(*x, y[2]) for x in left for y in right if x[:2] == y[:2]]
    want += [(*x, None) for x in left if how == "left" and not any(x[:2] == y[:2] for y in right)]
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert join_keep_left(a.limit(0), b, ["k", "j"], null_safe=True).count() == 0


def test_null_keys_do_not_meet_in_one_task(spark, plain):
    a = spark.range(9000).selectExpr("if(id % 3 = 0, null, id % 500) as k", "id")
    b = spark.range(500).selectExpr("if(id = 499, null, id) as k", "id * 2 as w")
    spread = join_keep_left(a, b, "k", keep=["w"], null_safe=True, skewed="left")
    assert spread.count() == 9000 - len([i for i in range(9000) if i % 3 and i % 500 == 499])
    assert largest_part(spread) < 0.2
    assert largest_part(a.join(b.withColumnRenamed("k", "o"), F.col("k").eqNullSafe(F.col("o")))) > 0.33


def test_null_and_hot_keys_together(spark, plain):
    a = spark.range(9000).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as k", "id")
    b = spark.createDataFrame([(None, "n"), (7, "h"), (8, "c"), (None, "m")], "k long, w string")
    got = join_keep_left(a, b, "k", hot="auto", null_safe=True, skewed="left")
    assert collections.Counter(r.w for r in got.collect()) == {"n": 3000, "m": 3000, "h": 3000, "c": 1}
    assert largest_part(got) < 0.2


def test_binned_scatter(spark):
    rng = random.Random(2)
    pts = [(rng.uniform(-1, 11), None if rng.random() < 0.1 else 1e6 + rng.uniform(0, 5)) for _ in range(3000)] + [(float("nan"), 1e6), (None, 1e6)]
    df = spark.createDataFrame([(x, y, "A" if i % 2 else "B") for i, (x, y) in enumerate(pts)], "x double, y double, State string")
    got = serving.scatter_binned(df, "x", "y", (0.0, 10.0), (1e6, 1e6 + 5), bins=4).collect()
    own = [(x, y) for x, y in pts if x is not None and y is not None and x == x]
    cell = lambda v, lo, hi: min(max(int((v - lo) // ((hi - lo) / 4)), 0), 3)
    want = collections.Counter((cell(x, 0, 10), cell(y, 1e6, 1e6 + 5)) for x, y in own)
    assert {(r.x_bin, r.y_bin): r.points for r in got} == want and len(got) <= 16
    fit = df.filter("not isnan(x)").selectExpr("regr_slope(y, x) s", "regr_intercept(y, x) i", "regr_r2(y, x) r").first()
    assert all(abs(r.slope - fit.s) < 1e-9 and abs(r.intercept - fit.i) < 1e-6 and abs(r.r2 - fit.r) < 1e-9 for r in got)
    assert sum(r.points for r in serving.scatter_binned(df, "x", "y", (0.0, 10.0), (1e6, 1e6 + 5), state="A").collect()) < len(own)
    assert serving.scatter_binned(df.limit(0), "x", "y", (0.0, 1.0), (0.0, 1.0)).count() == 0
    with pytest.raises(ValueError):
        serving.scatter_binned(df, "x", "y", (1.0, 1.0), (0.0, 1.0))


