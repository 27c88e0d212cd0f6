"""The longest run of words a text shares with a benchmark item."""

import random

from tests.llm import brute
from tests.llm.conftest import odd_texts, prose
from wardstat.llm import decontaminate


def longest_run(a, b):
    """(words, first word in a) of the longest common run."""
    best, before = (0, -1), [0] * (len(b) + 1)
    for i, x in enumerate(a):
        now = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                now[j + 1] = before[j] + 1
                if now[j + 1] > best[0]:
                    best = (now[j + 1], i + 1 - now[j + 1])
        before = now
    return best


def split(text):
    return brute.words(text or "", True, brute.ALNUM)


def holds(words, part):
    return any(words[i : i + len(part)] == part for i in range(len(words) - len(part) + 1))


def check(spark, docs, items, window):
    found = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame(items, "item_id string, text string"), window=window
    )
    rows = {r.doc_id: r for r in found.collect()}
    lengths = set()
    for i, text in docs:
        r, words = rows[i], split(text)
        runs = [longest_run(words, split(t)) for x, t in items if x is not None]
        most = max((n for n, _ in runs), default=0)
        at = min((p for n, p in runs if n == most), default=-1)
        assert (r.match_words, r.match_at) == (most, at if most else -1), i
        assert (r.match_item is None) == (most == 0)
        if most:
            assert any(x == r.match_item and holds(split(t), words[at : at + most]) for x, t in items)
        assert r.longest == min(most, window)
        lengths.add(most)
    return lengths


def test_longest_match_against_all_runs(spark):
    rng = random.Random(12)
    items = [(f"i{k}", prose(rng, n)) for k, n in enumerate((3, 12, 13, 14, 40, 200))]
    items += [("i0", prose(rng, 30)), ("z", None), (None, prose(rng, 20)), ("i9", "the of the of the of " * 4)]
    whole = [t.split() for x, t in items if x is not None and t]
    docs = [(0, items[5][1]), (1, None), (2, ""), (3, "nothing shared")]
    for k in range(60):
        w = rng.choice(whole)
        n = rng.randrange(1, len(w) + 1)
        # the last words of an item in many texts: all have to report them
        part = w[-n:] if k % 2 else w[:n]
        docs.append((10 + k, " ".join(["Anfang", str(k), *part, "Ende", *rng.choice(whole)[:3]])))
    lengths = check(spark, docs, items, 13)
    assert max(lengths) >= 200 and any(0 < n < 13 for n in lengths) and any(13 < n < 200 for n in lengths)
    check(spark, docs, items, 4)


def test_longest_match_of_odd_texts(spark):
    texts = [" ".join((t or "").split()[:130]) if t else t for t in odd_texts()]
    items = [("a", texts[9]), ("b", "same " * 20), ("c", "two words"), ("d", " ".join(texts[0].split()[5:60]))]
    check(spark, list(enumerate(texts)), items, 13)


def test_tail_of_an_item_is_found_in_every_text(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(i, f"x{i} w25 w26 w27 w28 w29 y{i}") for i in range(6)]
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame([("q", item)], "item_id string, text string"))
    assert {(r.match_words, r.match_at, r.match_item) for r in found.collect()} == {(5, 1, "q")}
