"""Collocations and their tries against plain counters."""

import random

import numpy as np
import pytest

from tests.llm import brute
from wardstat.llm import phrases
from wardstat.llm import text as T

SCHEMA = "text string, lang string, score int, words int, f string"


def sample(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "new", "York", "a\x01", "a", "ñandú", "日本", "x\x00y", "-", "b" * 50] + [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(None, "en"), ("", None), (" \t\n.", "de"), ("one", ""), ("New York. new york", "und")]
    for _ in range(n):
        w = rng.choices(words, weights, k=rng.randrange(60))
        text = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "!? "]) for x in w)
        rows.append((text, rng.choice(["en", "en", "de", None, ""])))
    return [*rows, rows[7], rows[7]]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "own") for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("least,longest,percent,top", [(3, 5, 100, 2000), (10, 5, 80, 15), (4, 3, 50, 2000), (2, 2, 100, 5)])
def test_collocations(spark, least, longest, percent, top):
    rows = sample(least, 250)
    found = phrases.collocations(table(spark, rows), min_count=least, max_words=longest, percent=percent, top=top).collect()
    assert sorted(map(tuple, found)) == brute.collocations(rows, least, longest, percent, top)


def test_small_tries_that_burst_and_spill(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_BYTES", 500)
    rows = [*sample(1, 120), (" ".join(f"w{i % 7}" for i in range(3000)), "en"), ("same line, " * 400, "de")]
    found = phrases.collocations(table(spark, rows), min_count=3, held=60, burst=5, filter_bits=1 << 16).collect()
    assert sorted(map(tuple, found)) == brute.collocations(rows, 3)


def test_counts(spark):
    rows = sample(9, 200)
    totals, counts = brute.phrase_table(rows)
    found = phrases.phrase_counts(table(spark, rows), min_count=4).collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found if r.phrase is not None} == {p: n for p, n in counts.items() if n >= 4}
    assert {r.lang: r.f for r in found if r.phrase is None} == {k: n for k, n in totals.items() if n}
    assert phrases.collocations(table(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("burst", [1, 3, 1000])
def test_trie_keeps_every_count(burst):
    rng = np.random.default_rng(burst)
    trie, want = phrases.HatTrie(4, burst), {}
    for _ in range(30):
        paths = rng.integers(0, 4, (200, 4)).astype(np.uint32) + 1
        paths[np.arange(4) >= rng.integers(1, 5, 200)[:, None]] = 0
        for p in map(tuple, paths.tolist()):
            want[p] = want.get(p, 0) + 1
        trie.add(*phrases._distinct(paths))
    assert trie.entries == len(want)
    got = {}
    half = [x for x in trie.spill(trie.entries // 2)]
    assert trie.entries <= len(want) // 2
    for paths, counts in [*half, *trie.spill()]:
        got.update(zip(map(tuple, paths.tolist()), counts.tolist()))
    assert got == want and trie.entries == 0


def test_products_beyond_64_bits(spark):
    exact = "(cast(a as decimal(15,0)) * 1000 * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    rows = [(10**14, 10**16, 10**15 + 3, 10**15 + 7), (7 * 10**12 + 1, 9 * 10**15, 10**13 + 9, 10**14 + 1)]
    found = spark.createDataFrame(rows, "a long, n long, l long, r long").selectExpr("a", f"{exact} as s").collect()
    assert {r.a: r.s for r in found} == {a: 1000 * a * n // (x * y) for a, n, x, y in rows}
