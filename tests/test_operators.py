import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from wardstat.operators.columns import normalize_headers, trim_all
from wardstat.operators.dedup import dedup_by_key, latest_per_key
from wardstat.operators.joins import join_keep_left
from wardstat.operators.quality import quality_counts
from wardstat.operators.select import band, equals, first_names, first_rows, one_of, present, top_n

T0 = dt.datetime(2024, 1, 1)


def test_trim_all_keeps_types_and_dotted_names(spark):
    df = spark.createDataFrame([(" a ", 1, " x.y ")], "`s` string, `n` int, `a.b` string")
    out = trim_all(df)
    assert out.columns == ["s", "n", "a.b"]
    assert dict(out.dtypes)["n"] == "int"
    assert tuple(out.first()) == ("a", 1, "x.y")
    assert tuple(trim_all(out).first()) == tuple(out.first())  # idempotent


def test_normalize_headers_trims_and_renames(spark):
    df = spark.createDataFrame([(" 015009 ", " 12 ")], ["CMS Certification Number (CCN)", "Score: Value"])
    out = normalize_headers(df, "extended")
    assert out.columns == ["CMS_Certification_Number_CCN", "Score_Value"]
    assert tuple(out.first()) == ("015009", "12")
    collide = spark.createDataFrame([(1, 2)], ["a-b", "a b"])
    with pytest.raises(ValueError):
        normalize_headers(collide)


def _snapshots(spark, data):
    return spark.createDataFrame(data, "ccn string, stamp timestamp, seq long, v double")


def test_latest_per_key_tie_break(spark):
    data = [
        ("1", T0, 1, 10.0),
        ("1", T0 + dt.timedelta(days=1), 2, 20.0),
        ("1", T0 + dt.timedelta(days=1), 3, 30.0),  # same stamp: tie-break picks seq 3
        ("2", None, 4, 40.0),
        ("2", T0, 5, 50.0),  # NULL stamps sort last
    ]
    out = latest_per_key(_snapshots(spark, data), "ccn", stamp="stamp", tie_break="seq")
    assert rows(out.select("ccn", "v")) == [("1", 30.0), ("2", 50.0)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=40
    ),
    st.integers(1, 6),
)
def test_latest_per_key_one_row_per_key_any_partitioning(spark, data, parts):
    recs = [(str(k), T0 + dt.timedelta(hours=h), i, float(i)) for i, (k, h, _) in enumerate(data)]
    df = _snapshots(spark, recs)
    a = rows(latest_per_key(df, "ccn", stamp="stamp", tie_break="seq"))
    b = rows(latest_per_key(df.repartition(parts), "ccn", stamp="stamp", tie_break="seq"))
    assert a == b
    assert len(a) == len({r[0] for r in recs})
    for key, stamp, seq, _ in a:
        cands = [r for r in recs if r[0] == key]
        best = max(cands, key=lambda r: (r[1], r[2]))
        assert (stamp, seq) == (best[1], best[2])


def test_dedup_by_key_total_order(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-01", 3.0), ("A", "2024-01-01", 1.0), ("A", "2024-01-02", 5.0), ("B", None, 1.0), ("B", None, 2.0)],
        "k string, d string, h double",
    )
    out = dedup_by_key(df, ["k", "d"])
    assert rows(out) == [("A", "2024-01-01", 1.0), ("A", "2024-01-02", 5.0), ("B", None, 1.0)]


def test_join_keep_left(spark):
    left = spark.createDataFrame([("1", "North", "NY"), ("2", "South", "CA")], "ccn string, name string, state string")
    right = spark.createDataFrame([("1", "North dup", "NY", 7.0), ("3", "x", "TX", 1.0)], "ccn string, name string, state string, score double")
    out = join_keep_left(left, right, "ccn")
    assert out.columns == ["ccn", "name", "state", "score"]
    assert rows(out) == [("1", "North", "NY", 7.0)]
    with pytest.raises(ValueError):
        join_keep_left(left, right, "ccn", keep=["state"])


def test_selection_helpers(spark):
    df = spark.createDataFrame(
        [("a", "NY", 1.0), ("b", "NY", 3.0), ("c", "CA", 3.0), ("d", "CA", None), ("a", "CA", 2.0)],
        "name string, state string, t double",
    )
    assert rows(equals(df, "state", None)) == rows(df)
    assert len(equals(df, "state", "CA").collect()) == 3
    assert rows(one_of(df, "name", [])) == rows(df)
    assert sorted(r.name for r in one_of(df, "name", ["a"]).collect()) == ["a", "a"]
    names = df.sparkSession.createDataFrame([("b",), ("c",)], "n string")
    assert sorted(r.name for r in one_of(df, "name", names).collect()) == ["b", "c"]
    top = top_n(df, 2, "t", tie_break="name").collect()
    assert [(r.name, r.t) for r in top] == [("b", 3.0), ("c", 3.0)]
    assert len(top_n(df, 10, "t", "name").collect()) == 4  # NULL never returned
    assert [r.name for r in first_names(df, "name", 2).collect()] == ["a", "b"]
    assert len(present(df, ["t"]).collect()) == 4
    assert [r.t for r in band(df, "t", 1, 3).collect()] == [2.0]
    assert [r.name for r in first_rows(df, 2, ["name", "state"]).collect()] == ["a", "a"]


def test_quality_counts(spark):
    df = spark.createDataFrame(
        [("1", " NY", "2024-01-01"), ("1", "NY", "2024-01-01"), (None, "CA", "2024-01-01"), ("2", None, None), ("2", "TX", None)],
        "k string, state string, d string",
    )
    out = dict(
        (r.check_name, r.n) for r in quality_counts(df, not_null=["k"], unique=["k", "d"], trimmed=["state"]).collect()
    )
    assert out == {"row_count": 5, "null_key": 1, "untrimmed": 2, "duplicate_key": 2}


from hypothesis import given, settings, HealthCheck as _HC  # noqa: E402
from hypothesis import strategies as _st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[_HC.function_scoped_fixture])
@given(_st.lists(_st.tuples(_st.text(alphabet=" \tab", max_size=4), _st.integers(0, 9)), min_size=1, max_size=12))
def test_trim_all_idempotent(spark, data):
    df = spark.createDataFrame(data, "s string, n int")
    once = trim_all(df)
    assert rows(trim_all(once)) == rows(once)
    assert all(r.s == r.s.strip(" ") for r in once.collect())


def test_salted_join_equals_plain_join(spark):
    fact = spark.createDataFrame(
        [("HOT", i, float(i)) for i in range(300)] + [(f"K{i}", i, 1.0) for i in range(50)],
        "ccn string, seq long, v double",
    )
    dim = spark.createDataFrame([("HOT", "Hot Place")] + [(f"K{i}", f"P{i}") for i in range(50)], "ccn string, name string")
    plain = rows(join_keep_left(dim, fact, "ccn"))
    salted = join_keep_left(dim, fact, "ccn", salt_buckets=8, skewed="right")
    assert rows(salted) == plain
    assert "__salt" not in salted.columns
    assert rows(join_keep_left(fact, dim, "ccn", salt_buckets=4, skewed="left")) == rows(join_keep_left(fact, dim, "ccn"))
    with pytest.raises(ValueError):
        join_keep_left(dim, fact, "ccn", how="left", salt_buckets=4)


def test_collect_bounded(spark):
    from wardstat.plans.serving import collect_bounded

    assert len(collect_bounded(spark.range(10), 10)) == 10
    with pytest.raises(ValueError):
        collect_bounded(spark.range(11), 10)


def test_keys_as_columns(spark):
    from pyspark.sql import functions as F

    df = _snapshots(spark, [("1", T0, 1, 1.0), ("1", T0, 2, 2.0), ("2", T0, 3, 3.0)])
    out = latest_per_key(df, F.col("ccn"), stamp="stamp", tie_break="seq")
    assert rows(out.select("ccn", "seq")) == [("1", 2), ("2", 3)]
    assert len(dedup_by_key(df, F.col("ccn")).collect()) == 2


def test_top_n_skips_nan_and_sorted_distinct_orders(spark):
    from wardstat.operators.select import sorted_distinct

    df = spark.createDataFrame([("a", float("nan")), ("b", 2.0), ("c", None), ("d", 1.0)], "k string, t double")
    assert [r.k for r in top_n(df, 3, "t", "k").collect()] == ["b", "d"]
    names = spark.createDataFrame([("z",), ("a",), (None,), ("m",), ("a",)], "n string")
    assert [r.n for r in sorted_distinct(names, "n").collect()] == ["a", "m", "z"]


def test_quality_counts_empty_table(spark):
    df = spark.createDataFrame([], "k string, state string")
    got = {r.check_name: r.n for r in quality_counts(df, not_null=["k"], unique=["k"], trimmed=["state"]).collect()}
    assert got == {"row_count": 0, "null_key": 0, "untrimmed": 0, "duplicate_key": 0}
