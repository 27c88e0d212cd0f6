"""Operators against plain-Python brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wardstat.operators.dedup import dedup_by_key
from wardstat.operators.quality import quality_counts
from wardstat.operators.select import top_n
from wardstat.sources.intake import changed_files

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)
minutes = st.integers(0, 50).map(lambda m: T0 + dt.timedelta(minutes=m))


@SETTINGS
@given(
    st.dictionaries(st.sampled_from(list("abcdefg")), minutes, min_size=1),
    st.lists(st.tuples(st.sampled_from(list("abcdefgh")), minutes), max_size=12),
)
def test_changed_files_brute_force(spark, listing, manifest):
    lst = spark.createDataFrame(sorted(listing.items()), "path string, modified timestamp")
    man = spark.createDataFrame(manifest, "path string, seen timestamp")
    got = sorted(r.path for r in changed_files(lst, man).collect())
    seen = {}
    for p, t in manifest:
        seen[p] = max(seen.get(p, t), t)
    want = sorted(p for p, m in listing.items() if m > seen.get(p, dt.datetime(1900, 1, 1)))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["1", "2", None]), st.sampled_from(["NY", " NY", None, "CA "]),
                          st.sampled_from(["d1", "d2", None])), min_size=1, max_size=15))
def test_quality_counts_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, state string, d string")
    got = {r.check_name: r.n for r in quality_counts(df, not_null=["k"], unique=["k", "d"], trimmed=["state"]).collect()}
    want = {
        "row_count": len(data),
        "null_key": sum(1 for k, _, _ in data if k is None),
        "untrimmed": sum(1 for _, s, _ in data if s is None or s.strip(" ") != s),
        "duplicate_key": len(data) - len({(k, d) for k, _, d in data}),
    }
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 5).map(float))), min_size=1, max_size=25,
                unique_by=lambda t: t[0]), st.integers(1, 6))
def test_top_n_brute_force(spark, data, n):
    df = spark.createDataFrame(data, "k int, v double")
    got = [(r.k, r.v) for r in top_n(df, n, "v", tie_break="k").collect()]
    want = sorted([d for d in data if d[1] is not None], key=lambda d: (-d[1], d[0]))[:n]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["x", "y"]), st.integers(0, 9), st.integers(0, 9)),
                min_size=1, max_size=20))
def test_dedup_by_key_brute_force(spark, data):
    df = spark.createDataFrame(data, "k1 string, k2 string, o1 int, o2 int")
    got = sorted(tuple(r) for r in dedup_by_key(df, ["k1", "k2"], ["o1", "o2"]).collect())
    best = {}
    for k1, k2, o1, o2 in data:
        cur = best.get((k1, k2))
        if cur is None or (o1, o2) < cur:
            best[(k1, k2)] = (o1, o2)
    want = sorted((k1, k2, o1, o2) for (k1, k2), (o1, o2) in best.items())
    assert got == want
