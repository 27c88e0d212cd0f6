"""Prefixes that are too common for one task are made longer."""

import random

import pytest

from tests.llm import brute
from tests.llm.conftest import prose
from wardstat.llm import substring_dedup


def documents():
    """A third of the texts carry a header of 8 to 34 words, some go on alike."""
    rng = random.Random(7)
    header = prose(rng, 34).split()[:34]
    tails = [prose(rng, 60) for _ in range(3)]
    docs = []
    for i in range(120):
        if i % 3 == 0:
            n = rng.choice((8, 12, 20, 30, 34))
            tail = rng.choice(tails) if i % 4 == 0 else prose(rng, 40)
            head = prose(rng, rng.randrange(30)) if i % 2 else prose(random.Random(1), 20)
            docs.append((i, " ".join([head, *header[:n], tail])))
        else:
            docs.append((i, prose(rng, 50)))
    return [*docs, *[(1000 + i, t) for i, (_, t) in enumerate(docs[:9])], (2000, "same " * 100)]


@pytest.mark.parametrize("group", [2, 8])
def test_one_prefix_in_a_third_of_all_texts(spark, monkeypatch, group):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    sizes = []
    trees = substring_dedup._trees

    def seen(entries, window, prefix, by="prefix"):
        sizes.extend(r["count"] for r in entries.groupBy(by).count().collect())
        return trees(entries, window, prefix, by)

    monkeypatch.setattr(substring_dedup, "_trees", seen)
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_words(df).collect()}
    assert got == brute.repeats(docs, 35)
    # no task is handed a group above GROUP
    assert max(sizes) <= group and any(v[1] for v in got.values())
