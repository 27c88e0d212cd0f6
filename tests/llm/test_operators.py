"""Every operator against its plain version on awkward input: nulls, empty
and very long texts, repeated texts and rows, empty tables, clashing names."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import odd_texts, pairs, prose
from wardstat.llm import (
    decontaminate,
    language_id,
    line_dedup,
    lm_scoring,
    mixing,
    mtree,
    near_dup,
    quality_mil,
    queries,
    substring_dedup,
    token_files,
)


def by_id(df):
    return {r.doc_id: tuple(r)[1:] for r in df.collect()}


# --- near duplicates -------------------------------------------------------------------


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, odd, nothing, size, percent):
    got = by_id(near_dup.near_duplicates(odd, shingle_words=size, percent=percent))
    assert got == brute.near_duplicates(pairs(odd), size, percent)
    assert near_dup.near_duplicates(nothing).count() == 0


def test_near_duplicates_in_blocks_with_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BUCKET_BLOCK", 4)
    monkeypatch.setattr(near_dup, "CLUSTER_BLOCK", 5)
    rng = random.Random(1)
    base = prose(rng, 150).split()
    docs = []
    for i in range(60):
        own = list(base)
        for _ in range(i % 12):
            own[rng.randrange(150)] = f"w{rng.random()}"
        docs.append((i, " ".join(own)))
    rows = [*docs, docs[3], (None, docs[4][1]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dup.near_duplicates(df, shingle_words=3, percent=85).collect()
    assert len(found) == len(rows)
    want = brute.near_duplicates(docs, 3, 85)
    assert {r.doc_id: tuple(r)[1:] for r in found if r.doc_id is not None} == want
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert 1 < len({v[1] for v in want.values()}) < 60


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 48, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate((common, rng.integers(0, 1 << 48, 100).astype(np.uint64)))) for _ in range(40)]
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    sk = near_dup.sketches(np.concatenate(sets), first, 125)
    agree = [(sk[i] == sk[j]).mean() for i in range(40) for j in range(i)]
    assert abs(np.mean(agree) - 300 / 500) < 0.02
    tiny = near_dup.sketches(np.array([7], np.uint64), np.array([0, 1, 1]), 125)
    assert (tiny[0] != near_dup._MAX).all() and (tiny[1] == near_dup._MAX).all()


# --- decontamination -------------------------------------------------------------------


def test_decontamination(spark, odd, nothing):
    t = odd_texts()
    items = [(1, t[9]), (2, "two words"), (3, None), (4, ""), (10, " ".join(t[0].split()[5:30])), (5, "same " * 20), (2, "not in there at all"), (None, t[0])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.decontamination(pairs(odd), items)  # items without an id count too
    found = decontaminate.overlaps(odd, bench)
    rows = found.withColumn("bad", decontaminate.contaminated()).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.bad) for r in rows} == want
    assert any(v[3] for v in want.values())
    for r in rows:
        assert sum(s.words for s in r.spans) == r.n_hit
        assert r.longest == 13 or not any(len(brute.words(x[1] or "", True, brute.ALNUM)) >= 13 for x in items) or r.longest < 13
    left = decontaminate.decontaminated(odd, bench)
    assert left.columns == odd.columns
    assert {r.doc_id for r in left.collect()} == {i for i, v in want.items() if not v[3]}
    assert left.filter("items != 'own' or n_words != 'own'").count() == 0
    assert decontaminate.overlaps(nothing, bench).count() == 0
    assert decontaminate.overlaps(odd, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_suffix_array_and_longest_match():
    rng = np.random.default_rng(0)
    h = np.concatenate((rng.integers(1, 4, 400), np.zeros(12, np.int64))).astype(np.uint64)
    order = decontaminate.suffix_array(h, np.arange(400), 12)
    keys = [tuple(h[p : p + 12].tolist()) for p in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(400))


def test_benchmark_in_parts_of_any_size(spark, monkeypatch, odd, nothing):
    """Parts, with items larger than one, find what the whole benchmark finds."""
    rows = [(f"i{i}", t) for i, (_, t) in enumerate(pairs(odd))] + [(None, "two words"), ("i0", "one"), ("i0", "one"), ("i2", None)]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    exact = ("doc_id", "n_words", "n_hit", "items", "spans", "longest", "longest_at", "match_words", "match_at")
    whole = {r.doc_id: r for r in decontaminate.overlaps(odd, bench, window=5).collect()}
    monkeypatch.setattr(decontaminate, "PART_BYTES", 9_000)
    parts = decontaminate.benchmark_parts(bench, "item_id", "text")
    assert len(parts) > 5 and sorted((r[0] or "", r[1] or "") for x in parts for r in x.collect()) == sorted({(i or "", t or "") for i, t in rows})
    got = {r.doc_id: r for r in decontaminate.overlaps(odd, bench, window=5).collect()}
    assert got.keys() == whole.keys()
    for i, r in got.items():
        assert [r[c] for c in exact] == [whole[i][c] for c in exact], i
        run = brute.words(r.text or "", True, brute.ALNUM)[r.match_at :][: r.match_words]
        holders = {x for x, t in rows if f" {' '.join(run)} " in f" {' '.join(brute.words(t or '', True, brute.ALNUM))} "}
        assert r.match_item in holders if run else r.match_item is None
    assert decontaminate.overlaps(nothing, bench, window=5).count() == 0


# --- repeated sequences ----------------------------------------------------------------


def test_repeated_words(spark, odd, nothing):
    want = brute.repeats(pairs(odd), 35)
    rows = substring_dedup.repeated_words(odd, with_text=True).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
    assert all(brute.sha(r.kept_text) == r.kept_sha256 and sum(s.words for s in r.spans) == r.n_removed for r in rows)
    assert any(v[1] for v in want.values())
    assert substring_dedup.repeated_words(nothing).count() == 0


def test_repeated_words_in_small_groups_with_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", 3)
    rng = random.Random(2)
    shared = [prose(rng, 45) for _ in range(4)]
    docs = [(i, prose(rng, rng.randrange(60)) + " " + rng.choice(shared) + " " + prose(rng, 20)) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_words(df).collect()}
    assert got == brute.repeats(docs, 35)
    twice = substring_dedup.repeated_words(df.union(df)).collect()
    assert len(twice) == 60 and all(r.n_removed == r.n_words for r in twice if r.n_words >= 35)


def test_subtrees_against_all_pairs():
    rng = np.random.default_rng(4)
    window, prefix, words, low, high = 12, 3, [], [], []
    for _ in range(60):
        left, right = rng.integers(0, 2, 6), rng.integers(0, 2, 9)
        hi, lo = int(rng.integers(0, 7)), 0
        lo = int(rng.integers(0, hi + 1))
        words.append(np.concatenate((left[:hi], [9, 9, 9], right[: window - 3 - lo])).astype(np.uint64) + np.uint64(1))
        low.append(lo)
        high.append(hi)
    got = substring_dedup.subtrees(np.zeros(60, np.int64), np.array(low), np.array(high), words, window, prefix)
    spans = [{o: tuple(x[h - o : h - o + window].tolist()) for o in range(lo, h + 1)} for x, lo, h in zip(words, low, high)]
    for i in range(60):
        want = sum(1 << o for o, s in spans[i].items() if any(spans[j].get(o) == s for j in range(60) if j != i))
        assert int(got[i]) == want


# --- lines ------------------------------------------------------------------------------


def test_line_duplicates(spark, odd, nothing):
    rng = random.Random(9)
    body = [prose(rng, 25) for _ in range(12)]
    docs = []
    for i in range(40):
        lines = [rng.choice(body) for _ in range(4)] + [prose(rng, 12), "", "ab", "short line"]
        w = lines[0].split()
        w[rng.randrange(25)] = f"new{i}"
        docs.append((i, "\n".join([" ".join(w), *lines])))
    docs += [(100, None), (101, ""), (102, "\n \n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("own"))
    found = line_dedup.duplicate_lines(df)
    got = {}
    for r in found.collect():
        n, kept = got.get(r.doc_id, (0, []))
        got[r.doc_id] = (n + 1, sorted([*kept, *([r.pos] if r.kept else [])]))
    assert got == brute.line_duplicates(docs)
    cleaned = line_dedup.deduplicated(df)
    assert cleaned.columns == df.columns and cleaned.count() == len(docs)
    for r in cleaned.collect():
        lines = [x for x in (r.text or "").split("\n") if x.strip()]
        assert len(lines) == len(got.get(r.doc_id, (0, []))[1])
    assert {r.doc_id: r.n_kept for r in line_dedup.duplicate_lines(odd).groupBy("doc_id").agg(F.count_if("kept").alias("n_kept")).collect()} == {
        i: len(k) for i, (_, k) in brute.line_duplicates(pairs(odd)).items()
    }
    assert line_dedup.duplicate_lines(nothing).count() == 0


# --- language-model scores --------------------------------------------------------------


def same_scores(got, want):
    assert got.keys() == want.keys()
    for i, (n, off, score) in want.items():
        assert got[i][:2] == (n, off)
        assert (got[i][2] is None) == (score is None) and (score is None or math.isclose(got[i][2], score, abs_tol=1e-9))


@pytest.mark.parametrize("part", [500_000, 90])
@pytest.mark.parametrize("least,order", [(1, 3), (2, 3), (3, 4), (2, 1)])
def test_stupid_backoff(spark, odd, nothing, monkeypatch, part, least, order):
    monkeypatch.setattr(lm_scoring, "PART_WORDS", part)
    same_scores(by_id(lm_scoring.stupid_backoff(odd, min_count=least, order=order)), brute.stupid_backoff(pairs(odd), least, order=order))


def test_stupid_backoff_by_another_corpus(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_WORDS", 200)
    known = odd.filter("doc_id % 2 = 0")
    texts = [t for _, t in pairs(known)]
    got = by_id(lm_scoring.stupid_backoff(odd, corpus=known))
    assert any(off for _, off, _ in got.values())
    same_scores(got, brute.stupid_backoff(pairs(odd), corpus=texts))
    assert {r.n_words for r in lm_scoring.stupid_backoff(odd.filter("text = 'one'"), corpus=nothing).collect()} == {1}


def test_stupid_backoff_with_a_word_in_a_third_of_all_places(spark, monkeypatch):
    """Hot words and phrases are one entry per chunk in their partition."""
    monkeypatch.setattr(lm_scoring, "PART_WORDS", 500)
    rng = random.Random(3)
    rows = [(i, " ".join("the" if rng.random() < 0.4 else f"w{rng.randrange(900)}" for _ in range(60))) for i in range(200)]
    same_scores(by_id(lm_scoring.stupid_backoff(spark.createDataFrame(rows, "doc_id long, text string"))), brute.stupid_backoff(rows))


def test_stupid_backoff_ids_and_empty_tables(spark, odd, nothing):
    assert lm_scoring.stupid_backoff(nothing).count() == 0
    rows = spark.createDataFrame([(None, "the of"), ("a", "one"), ("a", "one"), ("b", None)], "doc_id string, text string")
    got = sorted((str(r.doc_id), r.n_words, r.score is None) for r in lm_scoring.stupid_backoff(rows).collect())
    assert got == [("None", 2, False), ("a", 1, False), ("a", 1, False), ("b", 0, True)]
    twice = lm_scoring.stupid_backoff(odd.select("doc_id", "text").union(spark.createDataFrame([(None, "the of"), (1, "one")], "doc_id long, text string")))
    assert twice.count() == odd.count() + 2


# --- token files -------------------------------------------------------------------------


def direct_tokens(rows):
    from tokenizers import Tokenizer

    t, at, out = Tokenizer.from_file(queries.tokenizer_file()), 0, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return out


def test_token_blocks(spark, odd, nothing, tmp_path):
    path = str(tmp_path / "blocks")
    token_files.write_blocks(odd, path, queries.tokenizer_file())
    assert by_id(token_files.read_documents(spark.read.parquet(path))) == direct_tokens(pairs(odd))
    empty = str(tmp_path / "none")
    token_files.write_blocks(nothing, empty, queries.tokenizer_file())
    assert token_files.read_documents(spark.read.parquet(empty)).count() == 0


def test_token_ids_of_odd_words():
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng = random.Random(11)
    alphabet = "ab Z,.'!é ñ×÷'s'll <|endoftext|≯́=…日\x1c\x85\xa0\n\tſİß9_"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)] + odd_texts()
    file = open(queries.tokenizer_file(), "rb").read()
    words = token_files.WordIds(file)
    t = Tokenizer.from_file(queries.tokenizer_file())
    for text in texts:
        w = words.cut(pa.array([text], pa.string()))
        got, _ = words(w, token_files.tx.word_hashes(w))
        assert got.tolist() == t.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert token_files.splits_at_space(file)


def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(8)
    shapes = [rng.integers(0, 40000, 5000), np.zeros(700, np.int64), np.repeat(rng.integers(0, 50, 300), 9), np.array([49407]), np.tile([1, 2, 3], 900)]
    for ids in shapes:
        n = len(ids)
        pieces = [np.array([(7, 0, min(n, 8192), 3)], token_files.PIECE)]
        (raw,) = token_files._group_records(1, 0, ids, pieces)
        ((shard, first, got, back),) = token_files.read_records([raw])
        assert (shard, first) == (1, 0) and back.tolist() == ids.tolist() and got["id"][0] == 7
        for at in (5, len(raw) // 2, len(raw) - 1):
            bad = bytearray(raw)
            bad[at] ^= 16
            with pytest.raises(ValueError):
                list(token_files.read_records([bytes(bad)]))
    # a block is coded the same whatever blocks are beside it
    alone = token_files.encode_lanes(np.arange(300)[None, :] % 70, np.array([300]), np.array([70]))
    both = token_files.encode_lanes(np.stack((np.arange(300) % 70, np.arange(300) % 7)), np.array([300, 300]), np.array([70, 7]))
    assert alone[0] == both[0]
    skewed = np.repeat(np.arange(4), [5000, 50, 5, 1])
    assert len(token_files.encode_lanes(skewed[None, :], np.array([len(skewed)]), np.array([4]))[0]) < 200


def test_crc_of_parts():
    ids = np.arange(5000, dtype="<u4")
    parts = [ids[:10], ids[10:10], ids[10:4000], ids[4000:]]
    assert token_files.joined_crc([zlib.crc32(p.tobytes()) for p in parts], [len(p) for p in parts]) == zlib.crc32(ids.tobytes())


# --- languages ---------------------------------------------------------------------------


def test_language_id(spark, odd, nothing):
    rng = random.Random(3)
    sounds = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ei", "ber"], "cc": ["eau", "oi", "que", "ent"]}
    make = lambda lang, n: " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))
    rows = [(i, make(lang, 30), lang) for i, lang in enumerate(list(sounds) * 60)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !!", "cc"), (1003, "word", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("own"))
    model = language_id.fit(df.filter("doc_id % 4 != 2"), per_language=40)
    assert model.languages == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    wrong = [i for i, _, lang in rows[:180] if got[i].lang_best != lang]
    assert not wrong and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_best for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003].lang_best != "und"
    strange = spark.createDataFrame([(1, "жзик " * 40)], "doc_id long, text string")
    assert language_id.predict(strange, model).first().lang_pred == "und"
    assert language_id.predict(nothing, model).count() == 0
    none = language_id.fit(nothing)
    assert {r.lang_best for r in language_id.predict(odd, none).collect()} == {"und"}


def test_kneser_ney_sums_to_one():
    words = {"x": (["abab", "abba", "ba"], np.array([3, 2, 5]))}
    model = language_id.train(words)
    sym, first = language_id.symbols(["abab"])
    assert first.tolist() == [0, 6] and sym[0] == sym[-1] == language_id.EDGE
    # after "ab" the probabilities of a, b, the end and the unseen letter make 1
    heads = [model.score_words([f"ab{c}"])[0][0, 0] for c in "a"]
    assert all(h < 0 for h in heads)
    total = 0.0
    prefix = np.array([language_id.EDGE, ord("a"), ord("b")], np.int64)
    for nxt in (ord("a"), ord("b"), language_id.EDGE):
        s = np.concatenate((prefix, [nxt]))
        at, keys, have = language_id.grams(s, np.array([0, len(s)]), language_id.ORDER)
        row, hit = language_id.lookup(model.keys[4], keys[4][-1:])
        if hit[0]:
            total += math.exp(model.logp[4][row[0], 0])
        else:
            _, before, _ = language_id.grams_before(s, at)
            value, m = 0.0, 4
            while True:
                row, hit = language_id.lookup(model.keys[m], keys[m][-1:])
                if hit[0]:
                    value += model.logp[m][row[0], 0]
                    break
                r2, h2 = language_id.lookup(model.contexts[m], before[m - 1][-1:])
                value += model.backoff[m][r2[0], 0] if h2[0] else 0.0
                m -= 1
            total += math.exp(value)
    assert 0.8 < total < 1.0  # the rest belongs to letters never seen


# --- quality -----------------------------------------------------------------------------


def test_quality(spark, odd, nothing):
    rng = random.Random(6)
    good = lambda: prose(rng, rng.randrange(5, 400))
    bad = lambda: good()[:200] + " " + " ".join(w + rng.choice(["!!", "$$$", "%%%"]) for w in good().upper().split())
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 4 != 2] + [(None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    model = quality_mil.fit(docs, labels, per_label=150)
    scored = quality_mil.score(docs, model).collect()
    right = [(r.score >= 0.7) == bool(rows[r.doc_id][2]) for r in scored if r.doc_id % 4 == 2]
    assert sum(right) >= 0.95 * len(right)
    again = quality_mil.score(odd, model)
    assert again.columns == [*[c for c in odd.columns if c != "score"], "score"]
    assert all(0 <= r.score <= 1 for r in again.collect()) and again.count() == odd.count()
    assert quality_mil.score(nothing, model).count() == 0
    for only, want in ((1, 1.0), (0, 0.0)):
        one = quality_mil.fit(docs, labels.filter(f"quality = {only}"), per_label=20)
        assert {r.score for r in quality_mil.score(docs, one).collect()} == {want}
    assert {r.score for r in quality_mil.score(docs, quality_mil.fit(docs, labels.limit(0))).collect()} == {1.0}


def test_attention_finds_the_passage():
    """The passage that decides the label gets most of the weight."""
    rng = np.random.default_rng(0)
    x, first, label = [], [0], []
    for i in range(200):
        bag = rng.normal(0, 1, (6, quality_mil.N_FEATURES)).astype(np.float32)
        label.append(i % 2)
        if i % 2 == 0:
            bag[rng.integers(6), :3] += 6
        x.append(bag)
        first.append(first[-1] + 6)
    bags = quality_mil.Bags(np.concatenate(x), np.array(first))
    model = quality_mil.train(bags, np.array(label), epochs=20)
    assert ((model.score(bags) > 0.5) == np.array(label)).mean() > 0.95
    _, logit = model.passages(bags.x)
    odd_one = bags.x[:, :3].sum(1).reshape(-1, 6)[::2].argmax(1)
    assert (logit.reshape(-1, 6)[::2].argmax(1) == odd_one).mean() > 0.8


# --- mixing ------------------------------------------------------------------------------


def test_mixing(spark, odd, nothing):
    rows = [(i, f"s{i % 5}" if i % 7 else None, "w " * (i * 37 % 90)) for i in range(600)] + [(900, "tiny", "one two"), (901, "none", None), (901, "none", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("copies", F.lit("own"))
    got = mixing.mix(df, mixing.word_count(), F.lit(1.0)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        n = len((r.text or "").split())
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + n * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    assert math.isclose(sum(target.values()), sum(sizes.values()))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    free = [s for s in names if target[s] < 3 * sizes[s] - 1e-9]
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1
    assert all(abs(taken[s] - target[s]) <= 90 for s in names)
    assert mixing.mix(df, mixing.word_count(), F.lit(1.0)).select("doc_id", "source", "text", "copies").exceptAll(
        mixing.mix(df, mixing.word_count(), F.lit(1.0)).select("doc_id", "source", "text", "copies")).count() == 0
    assert mixing.mix(nothing, mixing.word_count(), F.lit(1.0)).count() == 0
    given = spark.createDataFrame([("s1", 50.0), ("s2", 1e9), ("gone", 5.0)], "source string, target double")
    part = mixing.mix(df, mixing.word_count(), F.lit(1.0), targets=given).groupBy("source").agg(
        F.sum(F.col("copies") * mixing.word_count()).alias("n")).collect()
    part = {r.source: r.n for r in part}
    assert abs(part["s1"] - 50) <= 45 and part["s2"] == 3 * sizes["s2"] and part["s3"] == 0
    weird = mixing.mix(odd, mixing.word_count(), F.lit(None).cast("double"))
    assert weird.count() == odd.count()


def test_heavier_weights_are_taken_more_often(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("x y").alias("text"))
    targets = spark.createDataFrame([("a", 2000.0)], "source string, target double")
    weight = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.2)
    got = mixing.mix(df, mixing.word_count(), weight, targets=targets).filter("copies > 0")
    even = got.filter("doc_id % 2 = 0").count() / got.count()
    assert abs(got.count() - 1000) <= 1 and even > 0.7


# --- top-k -------------------------------------------------------------------------------


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(mtree, "SHARD_ROWS", 40)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 3)
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.5, -0.25, 1.0, rng.gauss(0, 1)]) for _ in range(6)]) for i in range(200)]
    rows += [(300 + i, [0.5] * 6) for i in range(30)]  # ties
    rows += [(400, None), (450, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (550, [float("inf")] * 6), (600, [1.0, 2.0]), (650, []), (None, [0.5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("own"))
    vectors = df.select("vec_id", "score", mtree.quantised().alias("v"))
    got = [tuple(r) for r in mtree.top_k(vectors, F.col("vec_id") % 50 == 0, 5).collect()]
    good = {r.vec_id: r.v for r in vectors.collect() if r.v is not None and r.vec_id is not None}
    want = []
    for q, x in good.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good.items() if i != q and len(y) == len(x))
            want += [(q, k, i, -s) for k, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(got) == sorted(want)
    assert mtree.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_m_tree_skips_computations():
    rng = np.random.default_rng(1)
    centers = rng.integers(-2000, 2000, (30, 8))
    x = (centers[rng.integers(0, 30, 6000)] + rng.integers(-20, 20, (6000, 8))).astype(np.int64)
    tree = mtree.MTree(np.arange(6000), x)
    for q in (0, 17, 4000):
        best, computed = tree.search(x[q], 5, q)
        s = x @ x[q]
        s[q] = -(1 << 60)
        order = np.lexsort((np.arange(6000), -s))[:5]
        assert best == [(int(s[i]), int(i)) for i in order] and computed < 6000


def test_top_k_ships_no_tree(spark, monkeypatch):
    """A shard's rows meet whole parts of the queries where its tree is built,
    so that no row, and no batch of rows, holds a tree for each block."""
    monkeypatch.setattr(mtree, "SHARD_ROWS", 50)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 2)
    monkeypatch.setattr(mtree, "PART_BLOCKS", 3)
    rng = random.Random(11)
    for large in (40, 40_000, 1 << 31):  # components of 16, 32 and 64 bits
        rows = [(i % 150, [rng.randrange(-large, large), *(rng.randrange(-40, 40) for _ in range(4))]) for i in range(200)]  # ids that repeat, also those of queries
        rows += [(1000 + i, [large, -40, 0, 1, 1]) for i in range(20)]
        df = spark.createDataFrame(rows, "vec_id long, v array<long>")
        found = mtree.top_k(df, F.col("vec_id") % 10 == 0, 4)
        plan = found._jdf.queryExecution().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "tree" not in plan
        got = [tuple(r) for r in found.collect()]
        want, asked = [], {}
        for q, x in rows:
            if q % 10 == 0:
                asked.setdefault(q, []).extend((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)
        for q, scored in asked.items():
            want += [(q, k, i, -s) for k, (s, i) in enumerate(sorted(scored)[:4], 1)]
        assert sorted(r[:2] + r[3:] for r in got) == sorted(r[:2] + r[3:] for r in want)
        unique = {q for q in asked if sum(i == q for i, _ in rows) == 1}
        assert sorted(r for r in got if r[0] in unique) == sorted(r for r in want if r[0] in unique) and unique


def test_queries_of_a_block_each_get_their_own_best():
    rng = np.random.default_rng(2)
    x = rng.integers(-30, 30, (3000, 4))
    x[1000:2500] = x[rng.integers(0, 40, 1500)]  # many ties
    ids = rng.permutation(3000) // 2  # every id twice
    tree = mtree.MTree(ids, x)
    asked, own = np.concatenate((x[:60], rng.integers(-90, 90, (40, 4)))), np.concatenate((ids[:60], np.arange(5000, 5040)))
    query, found, scores = mtree.Search(tree, asked, 7, own).best()
    for j in range(100):
        s = x @ asked[j]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != own[j]][:7]
        assert list(zip(scores[query == j], found[query == j])) == [(s[i], ids[i]) for i in order]
        assert tree.search(asked[j], 7, own[j])[0] == [(s[i], ids[i]) for i in order]


# --- components --------------------------------------------------------------------------


def test_components(spark):
    from wardstat.llm.components import components

    rng = random.Random(7)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    links += [(5, 5), (None, 3), (4, None), (0, 1)]
    df = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = brute.union_find({x for p in real for x in p}, real)
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0
