import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of river stone light green walks Über señor naïve cloud 42 x, end. (and) don't über-fast ñandú".split()
#: columns whose names the operators use themselves
CLASH = ["score", "n_words", "items", "kept", "copies", "bands", "key", "label", "component", "n", "prefix", "size", "record", "lang_pred", "marks"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


def odd_texts():
    """Texts of every awkward kind."""
    rng = random.Random(5)
    base = prose(rng, 120)
    passage = prose(rng, 60)
    near = base.split()
    near[7] = "changed"
    return [
        base, None, "", " \t\n\x0b ", base, " ".join(near), "one", "two words", "three words here", passage,
        prose(rng, 50) + " " + passage, passage + "\n" + prose(rng, 30), "same " * 300, "same " * 90,
        prose(rng, 6000), "日本語の文章です 日本語", "!!! ??? 12 34", "a\n\na\nb\r\nb", "<|startoftext|> hi<|endoftext|>, it's Ａ",
        base.upper(), "é" * 500, "x" * 20000 + " tail", base + " and a little more",
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward texts with ids, with columns of clashing names."""
    rows = [(i * 3 + 1, t, ("en", "de", None)[i % 3], ("s1", "s0", None)[i % 3]) for i, t in enumerate(odd_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("own") for c in CLASH}).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
