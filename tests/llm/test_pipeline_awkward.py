"""Every pipeline stage on nulls, empty and repeated rows, ties, clashing
names and an empty table."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import CLASH, odd_texts, prose
from wardstat.llm import decontaminate, quality_mil
from wardstat.session import scratch_path

STAGES = dict(corpus_pipeline.STAGES)
NAMES = [*CLASH, "_copy", "_copies", "_id", "_source", "_n", "_weight", "_quality_score", "row_number", "mix_id", "n_hit"]


@pytest.fixture(scope="module")
def docs(spark):
    import random

    rng = random.Random(8)
    texts = odd_texts()
    rows = [(i * 3 + 1, t, ("en", "de", None)[i % 3], ("s1", "s0", None)[i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    a, b, c = prose(rng, 80), prose(rng, 90), prose(rng, 70)
    rows += [(500, a, "en", "s1", 1), (500, b, "en", "s1", 1), (None, c, None, "s0", 1), (None, c, None, "s0", 1), (None, a, "en", "s0", 1), (None, None, None, None, None)]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = scratch_path(spark, "awkward")
    df.withColumns({n: F.lit("own") for n in NAMES}).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def told(df):
    return collections.Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_quality_keeps_rows_as_they_are(spark, docs):
    out = STAGES["quality classifier"](spark, docs, SF_SMALL)
    assert out.columns == docs.columns and not told(out) - told(docs)
    # rows of one text are judged alike
    kept, all_ = collections.Counter(r.text for r in out.collect()), collections.Counter(r.text for r in docs.collect())
    assert all(n == all_[t] for t, n in kept.items())


def test_near_duplicates_lose_no_text(spark, docs):
    out = STAGES["MinHash near-dedup"](spark, docs, SF_SMALL)
    assert out.columns == docs.columns and not told(out) - told(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.near_duplicates(list(enumerate(t for _, t in rows)), 5, 80)
    groups = collections.defaultdict(list)
    for n, (i, _) in enumerate(rows):
        groups[want[n][1]].append((i is None, i or 0, rows[n][1] or "", rows[n][1] is None))
    best = collections.Counter(min(g)[:2] for g in groups.values())
    assert collections.Counter((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == best
    assert {r.text for r in out.collect() if r.doc_id == 500} == {t for i, t in rows if i == 500}
    assert all(r[n] == "own" for r in out.collect() for n in NAMES)


def test_decontamination_keeps_clean_rows(spark, docs):
    out = STAGES["benchmark decontamination"](spark, docs, SF_SMALL)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    clean = brute.decontamination(list(enumerate(t for t in {r.text for r in docs.collect()})), items)
    assert out.columns == docs.columns and not any(v[3] for v in clean.values())
    assert told(out) == told(docs)


def test_mixture_takes_rows_alike(spark, docs):
    out = STAGES["mixing sources to target weights"](spark, docs, SF_SMALL)
    assert out.columns == docs.columns and not set(told(out)) - set(told(docs))
    assert all(r[n] == "own" for r in out.collect() for n in NAMES)
    assert told(out) == told(STAGES["mixing sources to target weights"](spark, docs, SF_SMALL))


def test_tokens_of_every_row(spark, docs):
    out = STAGES["token-ID / binary output"](spark, docs, SF_SMALL).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(r.doc_id for r in docs.collect())
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


@pytest.mark.parametrize("stage", list(STAGES))
def test_no_rows(spark, docs, stage):
    assert STAGES[stage](spark, docs.limit(0), SF_SMALL).count() == 0


def test_items_without_id_hit_too(spark):
    words = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(None, words), (3, "other words " + words), (None, "short item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + words), (2, "a short item"), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.items) for r in decontaminate.overlaps(docs, items).collect()}
    assert got == {1: (40, ["3", None]), 2: (2, [None]), 3: (0, [])}


def test_every_passage_is_learned_from(spark):
    """The only bad passage of a long text lies where evenly spaced ones miss it."""
    good, bad = "good plain words here " * 12, "zzz qqq xxx " * 16
    texts = []
    for i in range(60):
        parts = [good] * 120
        if i % 2:
            parts[7 + i] = bad
        texts.append((i, " ".join(parts)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality_mil.fit(docs, labels)
    got = {r.doc_id: r.score >= 0.7 for r in quality_mil.score(docs, model).collect()}
    assert sum(got[i] == (i % 2 == 0) for i in range(60)) >= 57
    assert quality_mil.fit(docs, labels, max_passages=5).constant == 1.0
