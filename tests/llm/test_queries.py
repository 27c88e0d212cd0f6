"""The registered queries and the pipeline against plain versions (sf0.001)."""

import os
import zlib

import pytest

import corpus_pipeline
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from tests.llm.test_operators import direct_tokens
from wardstat.llm import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()


def rows_of(spark, name, sf=SF_SMALL):
    return queries.QUERIES[name](spark, sf).collect()


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries.QUERIES}
    assert numbers == set(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_op2(spark, docs):
    want = brute.stupid_backoff([(d.doc_id, d.text) for d in docs])
    for r in rows_of(spark, "op2_lm_scoring"):
        n, off, score = want.pop(r.doc_id)
        assert (r.n_words, r.n_backoff) == (n, off) and (score is None or abs(r.score - score) < 1e-9)
    assert not want


def test_op3_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    got = rows_of(spark, "op3_language_id", SF_CHECK)
    assert len(got) == len(truth) and all(r.held_out == held(r.doc_id) for r in got)
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(right) / len(right) > 0.98


def test_op5(spark, docs):
    want = brute.near_duplicates([(d.doc_id, d.text) for d in docs], 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows_of(spark, "op5_minhash_near_dedup")} == want


def test_op6(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.decontamination([(d.doc_id, d.text) for d in docs], items)
    want = {i: (n, hit, len(x), brute.sha(",".join(x)), bad) for i, (n, hit, x, bad) in want.items()}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows_of(spark, "op6_benchmark_decontamination")}
    assert got == want


def test_op7_held_out_accuracy(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    got = rows_of(spark, "op7_quality_classifier", SF_CHECK)
    assert all(r.held_out == held(r.doc_id) and r.predicted == int(r.score >= 0.7) for r in got)
    right = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(right) > 50 and sum(right) / len(right) > 0.95


def test_op8(spark, docs):
    want = brute.line_duplicates([(d.doc_id, d.text) for d in docs])
    got = {r.doc_id: (r.n_lines, r.kept_positions) for r in rows_of(spark, "op8_line_dedup")}
    assert got == want


def test_op9(spark, docs):
    want = brute.repeats([(d.doc_id, d.text) for d in docs], 35)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, "op9_substring_dedup")} == want


def test_op10(spark, docs):
    want = direct_tokens([(d.doc_id, d.text) for d in docs])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows_of(spark, "op10_token_output")} == want


def test_op11(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in rows_of(spark, "op11_conversation_structure_repair")} == brute.conversations(rows)


def test_op12(spark):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    assert sorted(map(tuple, rows_of(spark, "op12_phrase_collocations", SF_CHECK))) == brute.collocations(rows)


def test_op13(spark):
    from tests.llm.test_arc_convert import expected

    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in rows_of(spark, "op13_warc")), key=str) == expected(rows)


def test_pipeline_against_plain_stages(spark):
    """Each stage on what the stage before left."""
    left = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = left.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.source, r.text) for r in left.collect()]
        out = stage(spark, left, SF_SMALL)
        if name != "token-ID / binary output":
            assert out.columns == columns
        path = f"{queries.scratch_path(spark, 'test-stage')}"
        out.write.parquet(path)
        left = spark.read.parquet(path)
        seen[name] = (before, left.collect())
    assert len(corpus_pipeline.STAGES) == 5

    before, after = seen["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    wrong = [i for i, _, _ in before if i in labels and (i in kept) != (labels[i] == 1)]
    assert len(wrong) <= 0.05 * len(labels)

    before, after = seen["MinHash near-dedup"]
    want = brute.near_duplicates([(i, t) for i, _, t in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, v in want.items() if v[2])

    before, after = seen["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.decontamination([(i, t) for i, _, t in before], items)
    assert sorted(r.doc_id for r in after) == sorted(i for i, v in want.items() if not v[3])

    before, after = seen["mixing sources to target weights"]
    weights = {i: {1: 1.0, 0: 0.25}.get(labels.get(i), 0.7) for i, _, _ in before}
    want = brute.mixture([(i, s, len(brute.words(t))) for i, s, t in before], weights)
    count = {}
    for r in after:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {i: n for i, n in want.items() if n}

    before, after = seen["token-ID / binary output"]
    assert sum(r.n_tokens for r in after) == max(r.start + r.n_tokens for r in after)
    one = {i: v[1:] for i, v in direct_tokens([(i, t) for i, _, t in before]).items()}
    assert len(after) == len(before) and all((r.n_tokens, r.ids_crc32) == one[r.doc_id] for r in after)
    assert [r.doc_id for r in sorted(after, key=lambda r: r.start)] == sorted(i for i, _, _ in before)
