"""Repeated word sequences, found with prefix-partitioned suffix trees.

Every word sequence of ``window`` words that starts at two or more places is
repeated; the words it covers are removed everywhere.

1. Suffixes.  A tree over every word position would move each text many
   times over.  Instead each window names one of its ``PREFIX``-word
   sequences, the one with the smallest hash (the leftmost of equals), as its
   anchor.  Equal windows name equal anchors at the same offset, so a window
   can only be repeated if the suffix that begins at its anchor shares its
   first words with another one.  About one word position in fourteen is an
   anchor.
2. Prefix partitioning.  Anchors are counted by their first ``PREFIX`` words.
   A prefix that occurs once leads to a leaf and is dropped, which ends most
   suffixes.  The others are dealt into groups by prefix; equal suffixes with
   equal surroundings are merged first, so a passage with very many copies is
   one entry with a count.  A prefix of more than ``GROUP`` entries is made
   longer, by words to the right, until each of its groups fits or has one
   entry, which is dropped.  Windows that end inside the longer prefix are
   decided by map-side combined counts of the windows themselves.  A task
   takes whole groups until it holds ``GROUP`` entries, builds their trees and
   goes on to the next.
3. Subtrees.  The suffixes of a prefix are sorted word by word, only ties
   being read on, to full depth: the sorted order with the common depths of
   neighbours is the suffix tree.  For a window that begins ``o`` words
   before its anchor, the suffixes under the same internal node at depth
   ``window - o`` that also agree in the ``o`` words to the left repeat it.

Words are compared by 48-bit hashes, all ``window`` of them.  Only texts with
a repeated prefix are read a second time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm import text as tx
from wardstat.llm.components import written
from wardstat.llm.ship import ship

WINDOW = 35
PREFIX = 8
GROUP = 60_000  # suffixes whose trees a task holds at a time
WORD_BYTES = 6


def anchors(w: tx.Words, h: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, its anchor's position) for every window of a chunk, and
    the hash of the prefix at every word."""
    grams = tx.window_hashes(h, prefix)
    at = tx.inside_one_text(w, window)
    if not len(at):
        return at, at, grams
    n = window - prefix + 1
    best = grams[: len(grams) - n + 1] & ~np.uint64(63)
    for j in range(1, n):
        np.minimum(best, (grams[j : j + len(best)] & ~np.uint64(63)) | np.uint64(j), out=best)
    return at, at + (best[at] & np.uint64(63)).astype(np.int64), grams


def _row_key(id_col: str, text_col: str):
    return F.xxhash64(F.lit("row"), F.col(id_col), F.col(text_col))


def _digest(raw: bytes) -> str:
    return hashlib.sha256(b" ".join(raw.split())).hexdigest()


def _scan(docs: DataFrame, id_col: str, text_col: str, window: int, prefix: int) -> DataFrame:
    """Per text: key, words, digest of all words, anchors' prefixes and places."""

    def run(batches):
        for b in tx.chunks(batches, text_col):
            data, offsets = tx.utf8(b.column(text_col))
            w = tx.words(data, offsets)
            h = tx.word_hashes(w)
            _, anchor, grams = anchors(w, h, window, prefix)
            place = anchor[np.concatenate(([True], anchor[1:] != anchor[:-1]))] if len(anchor) else anchor
            cut = np.searchsorted(place, w.first).astype(np.int32)
            raw = data.tobytes()
            sha = [_digest(raw[a:z]) for a, z in zip(offsets[:-1], offsets[1:], strict=True)]
            inner = (place - np.repeat(w.first[:-1], np.diff(cut))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column(id_col), pa.array(w.counts), pa.array(sha),
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(grams[place].view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(inner))],
                names=["key", id_col, "n_words", "sha", "prefixes", "places"],
            )

    keyed = docs.select(_row_key(id_col, text_col).alias("key"), id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return keyed.mapInArrow(run, f"key long, {id_col} {kind}, n_words long, sha string, prefixes array<long>, places array<int>")


def _segments(touched: DataFrame, text_col: str, window: int, prefix: int) -> DataFrame:
    """A row per anchor with a repeated prefix: its windows' offsets
    (``low`` to ``high`` words before it) and the words they span."""

    def run(batches):
        for b in tx.chunks(batches, text_col):
            w = tx.words(*tx.utf8(b.column(text_col)))
            h = tx.word_hashes(w)
            at, anchor, grams = anchors(w, h, window, prefix)
            lists = b.column("places")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            per = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            wanted = np.sort(flat + np.repeat(w.first[:-1], per))
            pos = np.searchsorted(wanted, anchor)
            pos[pos == len(wanted)] = 0
            hit = np.flatnonzero(wanted[pos] == anchor) if len(wanted) else np.zeros(0, np.int64)
            if not len(hit):
                continue
            # windows that follow each other and share an anchor are one run
            a, o = anchor[hit], anchor[hit] - at[hit]
            begin = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
            last = np.concatenate((begin[1:], [len(a)])) - 1
            high, low, place = o[begin], o[last], a[begin]
            first, stop = place - high, place - low + window
            size = stop - first
            idx = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            packed = (h[idx] >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()
            edges = np.concatenate(([0], np.cumsum(size))) * WORD_BYTES
            words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(packed)])
            owner = np.searchsorted(w.first, place, side="right") - 1
            finger = []
            for seed in (0x51ED270B, 0x7F4A7C15):
                mixed = tx.mix64(h[idx] ^ tx.mix64(np.arange(len(idx)).astype(np.uint64) - np.repeat(np.cumsum(size) - size, size).astype(np.uint64) + np.uint64(seed)))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed)))
                total = sums[np.cumsum(size)] - sums[np.cumsum(size) - size]
                finger.append(tx.mix64(total ^ (high * 64 + low).astype(np.uint64)).view(np.int64))
            # the words once a chunk; equal entries are merged later anyhow
            _, one = np.unique(finger[0], return_index=True)
            again = np.ones(len(size), bool)
            again[one] = False
            words = words.cast(pa.binary()).take(pa.array(np.arange(len(size)), mask=again))
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[place].view(np.int64)), b.column("key").take(pa.array(owner)), pa.array((place - w.first[owner]).astype(np.int32)),
                 pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(finger[0]), pa.array(finger[1]), words],
                names=["prefix", "key", "place", "low", "high", "f1", "f2", "words"],
            )

    return touched.select("key", text_col, "places").mapInArrow(
        run, "prefix long, key long, place int, low int, high int, f1 long, f2 long, words binary")


def subtrees(group: np.ndarray, low: np.ndarray, high: np.ndarray, words: list[np.ndarray], window: int, prefix: int) -> np.ndarray:
    """Per entry a bit per offset: set if the window that begins so many
    words before the anchor is repeated in another entry.  ``words`` span
    from ``high`` words before the anchor to the last window's end; entries
    of a group share their first ``prefix`` words after the anchor."""
    n = len(group)
    size = np.array([len(x) for x in words], np.int64)
    edge = np.concatenate(([0], np.cumsum(size + 1)))
    flat = np.zeros(edge[-1] + window, np.uint64)
    flat[np.repeat(edge[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.concatenate(words)
    start = edge[:-1] + high
    stop = edge[1:] - 1
    order = np.argsort(group, kind="stable")
    depth_of = np.zeros(n, np.int64)  # common words with the entry before, in sorted order
    g = group[order]
    depth_of[1:] = np.where(g[1:] == g[:-1], window, 0)
    # the words to the right, word by word; past an entry's end each differs from all others
    for d in range(prefix, window):
        open_ = np.zeros(n, bool)
        same = depth_of[1:] == window
        open_[1:] |= same
        open_[:-1] |= same
        at = np.flatnonzero(open_)
        if not len(at):
            break
        run = np.cumsum(depth_of != window)
        e = order[at]
        inside = start[e] + d < stop[e]
        k = np.where(inside, flat[np.minimum(start[e] + d, len(flat) - 1)], e.astype(np.uint64) << np.uint64(48))
        by = np.lexsort((k, run[at]))
        order[at] = e[by]
        k, r = k[by], run[at]
        split = (r[1:] == r[:-1]) & (k[1:] != k[:-1])
        depth_of[at[1:][split]] = d
    repeated = np.zeros(n, np.int64)
    left = np.zeros(n, np.uint64)
    for o in range(window - prefix + 1):
        if o:
            pos = start - o
            has = high >= o
            left = np.where(has, tx.mix64(left * np.uint64(3) + flat[np.maximum(pos, 0)]), left)
        owns = np.flatnonzero((low <= o) & (o <= high))
        if len(owns) < 2:
            continue
        node = np.empty(n, np.int64)
        node[order] = np.cumsum(depth_of < window - o)
        key = tx.mix64(node[owns].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ left[owns])
        by = np.argsort(key)
        twin = key[by][1:] == key[by][:-1]
        hit = np.zeros(len(owns), bool)
        hit[by[1:][twin]] = True
        hit[by[:-1][twin]] = True
        repeated[owns[hit]] |= np.int64(1) << o
    return repeated


def _unpack(raw: pa.Array) -> list[np.ndarray]:
    out = []
    for x in raw:
        b = np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, WORD_BYTES)
        wide = np.zeros((len(b), 8), np.uint8)
        wide[:, :WORD_BYTES] = b
        out.append(wide.view(np.uint64).reshape(-1) + np.uint64(1))
    return out


def _trees(entries: DataFrame, window: int, prefix: int, by: str = "prefix") -> DataFrame:
    """(prefix, f1, f2, offsets): the repeated windows of every distinct
    entry; entries of equal ``by`` share their first ``prefix`` words."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table):
            table = table.combine_chunks()
            c = {k: table.column(k).combine_chunks() if table.num_rows else None for k in table.column_names}
            num = {k: c[k].to_numpy(zero_copy_only=False) for k in (by, "low", "high", "copies")}
            bits = subtrees(num[by], num["low"].astype(np.int64), num["high"].astype(np.int64), _unpack(c["words"]), window, prefix)
            full = (np.int64(1) << (num["high"] + 1).astype(np.int64)) - (np.int64(1) << num["low"].astype(np.int64))
            bits = np.where(num["copies"] > 1, full, bits)
            return pa.RecordBatch.from_arrays([c["prefix"], c["f1"], c["f2"], pa.array(bits)], names=["prefix", "f1", "f2", "offsets"]).filter(pa.array(bits != 0))

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= GROUP:
                # whole groups only: the last one may go on in the next batch
                table = pa.Table.from_batches(held)
                p = table.column(by).to_numpy()
                cut = int(np.searchsorted(p, p[-1], side="left"))
                if cut:
                    yield solve(table.slice(0, cut))
                    held, rows = table.slice(cut).to_batches(), len(p) - cut
        if rows:
            yield solve(pa.Table.from_batches(held))

    columns = dict.fromkeys([by, "prefix", "f1", "f2", "low", "high", "copies", "words"])
    dealt = entries.select(*columns).repartition(by).sortWithinPartitions(by)
    return dealt.mapInArrow(run, "prefix long, f1 long, f2 long, offsets long")


def _ended(entries: DataFrame, window: int, depth: int, longer: int) -> DataFrame:
    """(prefix, f1, f2, offsets): the repeated ones of the windows that end
    ``depth`` to ``longer`` - 1 words after their anchor's begin."""
    low, high = F.greatest(F.col("low"), F.lit(window - longer + 1)), F.least(F.col("high"), F.lit(window - depth))
    one = entries.select("prefix", "f1", "f2", "copies", "high", "words", low.alias("_lo"), high.alias("_hi")).filter("_lo <= _hi")
    one = one.withColumn("o", F.explode(F.sequence("_lo", "_hi")))
    own = F.expr(f"substring(words, 1 + {WORD_BYTES} * (high - o), {WORD_BYTES * window})")
    keyed = one.select("prefix", "f1", "f2", "copies", "o", F.xxhash64(own).alias("w1"), F.xxhash64(F.lit("w2"), own).alias("w2"))
    again = keyed.groupBy("o", "w1", "w2").agg(F.sum("copies").alias("n")).filter("n > 1").drop("n")
    return keyed.join(again, ["o", "w1", "w2"]).groupBy("prefix", "f1", "f2").agg(F.bit_or(F.expr("shiftleft(1L, o)")).alias("offsets"))


def _long_prefixes(entries: DataFrame, window: int, prefix: int) -> DataFrame:
    """What ``_trees`` finds, for entries whose prefixes are too common for
    one task.  An entry can have several rows, whose offsets add up."""
    full = F.expr("shiftleft(1L, high + 1) - shiftleft(1L, low)")
    found = entries.filter("copies > 1").select("prefix", "f1", "f2", full.alias("offsets"))
    open_, depth = entries.withColumn("node", F.col("prefix")), prefix
    while True:
        sizes = open_.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        fit = open_.join(sizes.filter(F.col("n") <= GROUP).select("node"), "node", "left_semi")
        found = found.unionByName(_trees(fit, window, depth, "node"))
        open_ = open_.join(sizes.filter(F.col("n") > GROUP).select("node"), "node", "left_semi")
        open_ = written(open_, "repeats-open")
        if not open_.limit(1).count():
            return found
        longer = min(2 * depth, window + 1)
        found = found.unionByName(_ended(open_, window, depth, longer))
        # the windows that are left go on behind the longer prefix
        next_words = F.expr(f"substring(words, 1 + {WORD_BYTES} * (high + {depth}), {WORD_BYTES * (longer - depth)})")
        trimmed = F.expr(f"substring(words, 1 + {WORD_BYTES} * greatest(high - {window - longer}, 0))")
        open_ = open_.filter(F.col("low") <= window - longer).select(
            F.xxhash64("node", next_words).alias("node"), "prefix", "f1", "f2", "copies", "low",
            F.least(F.col("high"), F.lit(window - longer)).alias("high"), trimmed.alias("words"))
        depth = longer


def repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, prefix: int = PREFIX, with_text: bool = False
) -> DataFrame:
    """Per row: id, n_words, n_removed, spans (first word and number of words
    of each removed stretch), kept_sha256 of the kept words joined by one
    space, and with ``with_text`` those words as ``kept_text``.

    Words are runs without ASCII white space, unchanged.  A word is removed
    if a repeated window covers it; rows repeated in the table repeat each
    other.  Null and empty texts have no words.  Extra columns are ignored.
    """
    if not prefix <= window < prefix + 60:
        raise ValueError("window must be from prefix to prefix + 59 words")
    ship(docs.sparkSession)
    scanned = written(_scan(docs, id_col, text_col, window, prefix), "repeats-scan")
    rows = scanned.select("key", F.explode(F.arrays_zip("prefixes", "places")).alias("x")).select("key", F.col("x.prefixes").alias("prefix"), F.col("x.places").alias("place"))
    common = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("prefix")
    places = rows.join(common, "prefix").groupBy("key").agg(F.collect_set("place").alias("places"))
    keyed = docs.select(_row_key(id_col, text_col).alias("key"), id_col, text_col)
    touched = written(keyed.join(places, "key"), "repeats-texts")
    segments = written(_segments(touched, text_col, window, prefix), "repeats-segments")
    entries = segments.groupBy("prefix", "f1", "f2").agg(
        F.count(F.lit(1)).alias("copies"), F.first("low").alias("low"), F.first("high").alias("high"),
        F.first("words", ignorenulls=True).alias("words"))
    crowded = written(segments.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP).select("prefix"), "repeats-crowded")
    if crowded.limit(1).count():
        rest = written(entries.join(crowded, "prefix", "left_semi"), "repeats-open")
        offsets = _trees(entries.join(crowded, "prefix", "left_anti"), window, prefix).unionByName(_long_prefixes(rest, window, prefix))
    else:
        offsets = _trees(entries, window, prefix)
    found = (
        segments.drop("words", "low", "high").join(offsets, ["prefix", "f1", "f2"])
        .groupBy("key").agg(F.collect_set(F.struct("place", "offsets")).alias("marks"))
    )
    marks = written(found, "repeats-marks")
    hit = touched.drop("places").join(marks, "key")

    def run(batches):
        for b in tx.chunks(batches, text_col):
            data, offsets = tx.utf8(b.column(text_col))
            w = tx.words(data, offsets)
            lists = b.column("marks")
            per = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            inner = lists.flatten()
            place = inner.field("place").to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(w.first[:-1], per)
            bits = inner.field("offsets").to_numpy(zero_copy_only=False)
            edge = np.zeros(len(w.start) + 1, np.int64)
            for o in range(window - prefix + 1):
                start = place[(bits >> o) & 1 > 0] - o
                np.add.at(edge, start, 1)
                np.add.at(edge, start + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            sums = np.concatenate(([0], np.cumsum(gone)))
            removed = sums[w.first[1:]] - sums[w.first[:-1]]
            raw = data.tobytes()
            sha, texts, spans = [], [], []
            for t in range(b.num_rows):
                a, z = w.first[t], w.first[t + 1]
                stay = np.flatnonzero(~gone[a:z]) + a
                kept = b" ".join([raw[s:e] for s, e in zip(w.start[stay].tolist(), w.end[stay].tolist(), strict=True)])
                sha.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if with_text else None)
                flips = np.flatnonzero(np.diff(np.concatenate(([0], gone[a:z].astype(np.int8), [0]))))
                spans.append([{"first": int(s), "words": int(e - s)} for s, e in flips.reshape(-1, 2)])
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), pa.array(w.counts), pa.array(removed),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))), pa.array(sha), pa.array(texts, pa.string())],
                names=[id_col, "n_words", "n_removed", "spans", "kept_sha256", "kept_text"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    spans_type = "array<struct<first:long,words:long>>"
    changed = hit.mapInArrow(run, f"{id_col} {kind}, n_words long, n_removed long, spans {spans_type}, kept_sha256 string, kept_text string")
    clean = scanned.select("key", id_col, "n_words", "sha").join(marks.select("key"), "key", "left_anti")
    text_of = F.lit(None).cast("string")
    if with_text:
        words = F.regexp_replace(F.coalesce(text_col, F.lit("")), r"[\x20\x09-\x0D]+", " ")
        # texts that nothing repeats have to be read for their words
        own = keyed.select("key", F.trim(words).alias("kept_text")).dropDuplicates(["key"])
        clean = clean.join(own, "key")
        text_of = F.col("kept_text")
    same = clean.select(id_col, "n_words", F.lit(0).cast("long").alias("n_removed"), F.expr(f"cast(array() as {spans_type})").alias("spans"),
                        F.col("sha").alias("kept_sha256"), text_of.alias("kept_text"))
    out = changed.unionByName(same)
    return out if with_text else out.drop("kept_text")
