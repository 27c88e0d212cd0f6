"""Repair of conversations against plain dynamic programming."""

import random

import pytest

from tests.llm import brute
from wardstat.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, score int, place int, edit string"
TEXTS = ["Yes.", "No!", "and then", "", " \t", "Yes.", "ünd.", "what?\n", None, "a\nb.", "\x85"]
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "USER"]


def sample(seed, convs, turns):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(convs)]:
        for t in range(rng.randrange(turns + 1)):
            turn = rng.choice([t, t, t, t + rng.randrange(3), None])
            rows.append((c, turn, rng.choice(ROLES), rng.choice(TEXTS), 1, 2, "own"))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def result(spark, rows):
    df = table(spark, rows)
    found = repair.audit(repair.damaged(df), df).collect()
    return {r[0]: tuple(r)[1:] for r in found}


@pytest.mark.parametrize("seed", range(3))
def test_states_of_short_runs(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), "t", rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(10))]
        codes = "".join(repair.code_of(r[:1], fault) for r, _, fault in rows)
        assert repair.best_edits(codes) == brute.cheapest_edits(rows)[:2]


def test_awkward_rows(spark):
    rows = sample(1, 60, 12)
    got = result(spark, rows)
    want = brute.conversations([r[:4] for r in rows])
    assert got == want


def test_one_long_conversation_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_BITS", 2)
    monkeypatch.setattr(repair, "FAN", 3)
    rows = sample(2, 6, 9) + [(77, t, r, x, 0, 0, "") for t, (r, x) in enumerate(zip(random.Random(3).choices(ROLES, k=400), random.Random(4).choices([*TEXTS, *map(str, range(300))], k=400)))]
    assert result(spark, rows) == brute.conversations([r[:4] for r in rows])


def test_repeated_rows_hold_most_of_the_table(spark):
    rows = [(5, 1, "user", "Same.", 0, 0, "")] * 700 + sample(5, 5, 5)
    assert result(spark, rows) == brute.conversations([r[:4] for r in rows])


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", " "), (1, 3, "assistant", "Fine."), (2, 0, "system", "Rules."), (3, 0, "tool", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted(tuple(r) for r in repair.Repair(df).repaired().collect())
    # DKDK and KDDK cost the same
    assert found == [(1, 0, "K", "user", "Again."), (1, 1, "K", "assistant", "Fine.")]


def test_text_ids_and_no_rows(spark):
    df = spark.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "assistant", "Yes.")], "conv_id string, turn int, role string, text string")
    one = repair.audit(df, df).collect()
    assert [(r.conv_id, r.cost, r.audit) for r in one] == [("x", 0, "KK")]
    empty = df.limit(0)
    assert repair.audit(repair.damaged(empty), empty).count() == 0
    assert [tuple(r) for r in repair.audit(empty, df).collect()] == [("x", 0, 0, 0, 0, 0, 0, "", brute.sha(""))]
