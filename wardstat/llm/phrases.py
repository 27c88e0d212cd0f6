"""Collocations: phrases of a language whose words stand together far more
often than their parts would.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and
the pieces at spaces and tabs into words.  For every language (null: ``und``)
f(phrase) is the number of its occurrences inside pieces, overlaps included.
A candidate is a phrase of 2 to ``max_words`` words with f >= ``min_count``;
its score is floor(1000 * a * n / (l * r)), a = f(phrase), n all words of the
language, l and r the counts of the two parts of the cut that scores lowest
(ties: the shortest first part).  A candidate is dropped if its words lie
inside a longer candidate that has at least ``percent`` per cent of its count.

Counting.  A task counts in HAT-tries: under a shallow trie of word ids hang
hash containers (tables of packed ids).  A container covers a range of the
next word's ids; one with too many entries bursts, into two containers of half
the range, or, if its range is a single word, into a trie node for that word.
Only the longest path at a place is inserted; the counts of shorter phrases
are sums over subtrees.  When a trie holds too many entries, whole subtrees
leave it, the largest first, as runs sorted by the words' bytes, and runs are
merged per prefix partition: the shuffle is by the first ``PREFIX`` words.

Nothing can be a candidate that holds a word, or a pair of neighbours, with
fewer than ``min_count`` occurrences.  So words are counted first; then the
hashes of pairs of words that may be frequent, which bounds the counts of pairs
from above; then, by their words, the phrases of pairs that may be frequent.
"May be" is a bit per hash, in a filter of at most ``FILTER_BITS`` bits
whatever the corpus: a wrong bit costs work, never a wrong result.

Word identity is exact between tasks (runs carry words); inside a chunk of a
few MB it is a 64-bit hash.

Defined results: null and empty texts have no words; a language without
candidates has no rows; an empty table gives none; repeated rows and ids count
as often as they stand there; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.llm import text as T
from wardstat.llm.components import written
from wardstat.llm.ship import ship

BURST = 4096  # entries of a hash container
HELD = 400_000  # entries and words of a task's tries
PREFIX = 3  # words that name the partition where runs are merged
FILTER_BITS = 1 << 27
SLICE_BITS = 1 << 16
PAIRS_HELD = 2_000_000  # hashes of pairs of a task
PART_PAIRS = 4_000_000  # neighbours, by number of words, whose hashes are merged in a task
RUN_ROWS = 20_000

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


# --- the trie -----------------------------------------------------------------------------


class Container:
    """A hash table of packed paths whose next word id is in [low, high).

    A path is ``width`` ids of four bytes, big end first, with zeros behind its
    last word, so that equal paths are equal bytes and ids sort like bytes."""

    __slots__ = ("table", "low", "high")

    def __init__(self, low: int, high: int) -> None:
        self.table: dict[bytes, int] = {}
        self.low, self.high = low, high


class Node:
    """A trie node: containers by ranges of the next word's id, and children
    for single words."""

    __slots__ = ("starts", "parts")

    def __init__(self, high: int = 1 << 32) -> None:
        self.starts: list[int] = [0]
        self.parts: list[Container | Node] = [Container(0, high)]


class HatTrie:
    """Counts of paths of word ids (1 and up) with at most ``width`` words."""

    def __init__(self, width: int, burst: int = BURST) -> None:
        self.width, self.burst = width, burst
        self.root, self.entries = Node(), 0

    def add(self, paths: np.ndarray, counts: np.ndarray) -> None:
        """``paths`` are distinct sorted rows of ids."""
        self._add(self.root, paths, counts, 0)

    def _add(self, node: Node, paths: np.ndarray, counts: np.ndarray, depth: int) -> None:
        edges = np.searchsorted(paths[:, depth], np.array(node.starts, np.uint64))
        edges = [*edges.tolist(), len(paths)]
        full = []
        for k, part in enumerate(node.parts):
            lo, hi = edges[k], edges[k + 1]
            if lo == hi:
                continue
            if isinstance(part, Node):
                self._add(part, paths[lo:hi], counts[lo:hi], depth + 1)
                continue
            table, before = part.table, len(part.table)
            for key, n in zip(_packed(paths[lo:hi]), counts[lo:hi].tolist()):
                table[key] = table.get(key, 0) + n
            self.entries += len(table) - before
            if len(table) > self.burst:
                full.append(part)
        for part in full:
            self._burst(node, part, depth)

    def _burst(self, node: Node, part: Container, depth: int) -> None:
        open_ = [part]
        while open_:
            one = open_.pop()
            if len(one.table) <= self.burst:
                continue
            at = node.parts.index(one)
            if one.high - one.low > 1:  # two containers, split at the middle entry
                ids = sorted(int.from_bytes(k[4 * depth : 4 * depth + 4]) for k in one.table)
                middle = ids[len(ids) // 2]
                middle = middle if middle > one.low else min(one.high - 1, middle + 1)
                halves = [Container(one.low, middle), Container(middle, one.high)]
                for k, n in one.table.items():
                    halves[int.from_bytes(k[4 * depth : 4 * depth + 4]) >= middle].table[k] = n
                node.parts[at : at + 1] = halves
                node.starts.insert(at + 1, middle)
                open_ += halves
            elif depth + 1 < self.width:  # one word: a node below it
                below = Node()
                below.parts[0].table = one.table
                node.parts[at] = below
                self._burst(below, below.parts[0], depth + 1)

    def subtrees(self) -> list[tuple[int, Container | Node]]:
        """(entries, subtree) right below the root."""
        return [(_size(p), p) for p in self.root.parts]

    def spill(self, keep: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Subtrees, the largest first, until at most ``keep`` entries stay;
        each as (paths, counts), and empty afterwards."""
        for size, part in sorted(self.subtrees(), key=lambda x: -x[0]):
            if self.entries <= keep or not size:
                break
            tables: list[dict[bytes, int]] = []
            _tables(part, tables)
            keys = b"".join(k for t in tables for k in t)
            paths = np.frombuffer(keys, ">u4").reshape(-1, self.width).astype(np.uint32)
            yield paths, np.array([n for t in tables for n in t.values()], np.int64)
            at = self.root.parts.index(part)
            high = self.root.starts[at + 1] if at + 1 < len(self.root.starts) else 1 << 32
            self.root.parts[at] = Container(self.root.starts[at], high)
            self.entries -= size


def _packed(paths: np.ndarray) -> list[bytes]:
    wide = np.ascontiguousarray(paths.astype(">u4"))
    return wide.view(np.dtype((np.void, 4 * paths.shape[1]))).ravel().tolist()


def _size(part: Container | Node) -> int:
    return len(part.table) if isinstance(part, Container) else sum(map(_size, part.parts))


def _tables(part: Container | Node, out: list[dict[bytes, int]]) -> None:
    if isinstance(part, Container):
        out.append(part.table)
    else:
        for p in part.parts:
            _tables(p, out)


def _distinct(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows and how often each stands there."""
    if paths.shape[1] == 1:
        one, n = np.unique(paths[:, 0], return_counts=True)
        return one[:, None], n
    if paths.shape[1] == 2:
        both, n = np.unique(paths[:, 0].astype(np.uint64) << np.uint64(32) | paths[:, 1], return_counts=True)
        return np.stack([(both >> np.uint64(32)).astype(np.uint32), both.astype(np.uint32)], 1), n
    paths = paths[np.lexsort(paths.T[::-1])]
    new = np.ones(len(paths), bool)
    new[1:] = (paths[1:] != paths[:-1]).any(1)
    at = np.flatnonzero(new)
    return paths[at], np.diff([*at, len(paths)])


class Counter:
    """The tries of a task, one per language, and its words' ids."""

    def __init__(self, width: int, least: int, held: int = HELD, burst: int = BURST) -> None:
        self.width, self.least, self.held, self.burst = width, least, held, burst
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.names: list[bytes] = [b""]
        self.tries: dict[str, HatTrie] = {}

    def id_of(self, words: list[bytes]) -> np.ndarray:
        ids, names = self.ids, self.names
        out = np.empty(len(words), np.uint32)
        for k, w in enumerate(words):
            i = ids.get(w)
            if i is None:
                ids[w] = i = len(names)
                names.append(w)
            out[k] = i
        return out

    def add(self, lang: str, paths: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(paths):
            return
        trie = self.tries.setdefault(lang, HatTrie(self.width, self.burst))
        trie.add(*_distinct(paths))
        if len(self.names) > 2 * self.held:
            yield from self.flush()
        elif sum(t.entries for t in self.tries.values()) > self.held:
            for name, t in self.tries.items():
                for paths_, counts in t.spill(t.entries // 2):
                    yield from self._run(name, paths_, counts)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for name, t in self.tries.items():
            for paths, counts in t.spill():
                yield from self._run(name, paths, counts)
        self.clear()

    def _run(self, lang: str, paths: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A subtree as a run: every phrase of ``least`` words or more below
        it, sorted, with its count; a shorter phrase has the sum of the longer
        ones that begin with it and of its own."""
        used = np.unique(paths)
        rank = np.zeros(int(used[-1]) + 1, np.uint32)
        order = sorted(used[used > 0].tolist(), key=self.names.__getitem__)
        rank[order] = np.arange(1, len(order) + 1)
        names = [b"", *(self.names[i] for i in order)]
        paths = rank[paths]
        by = np.lexsort(paths.T[::-1])
        paths, counts = paths[by], counts[by]
        length = (paths > 0).sum(1)
        before = np.concatenate([[0], np.cumsum(counts)])
        changed = np.ones(len(paths), bool)  # the first k words are others than in the row before
        out = []
        changed[1:] = False
        for k in range(1, self.width + 1):
            changed[1:] |= paths[1:, k - 1] != paths[:-1, k - 1]
            if k < self.least:
                continue
            at = np.flatnonzero(changed & (length >= k))
            nxt = np.append(np.flatnonzero(changed), len(paths))
            ends = nxt[np.searchsorted(nxt, at, side="right")]
            out.append((at, np.full(len(at), k), before[ends] - before[at]))
        at, k, n = (np.concatenate(x) for x in zip(*out))
        by = np.lexsort((k, at))
        at, k, n = at[by], k[by], n[by]
        for lo in range(0, len(at), RUN_ROWS):
            hi = min(lo + RUN_ROWS, len(at))
            own = paths[at[lo:hi]].tolist()
            words = [[names[i] for i in p[:m]] for p, m in zip(own, k[lo:hi].tolist())]
            phrase = pa.array([b" ".join(w) for w in words], pa.binary())
            prefix = pa.array([b" ".join(w[:PREFIX]) for w in words], pa.binary())
            size = hi - lo
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), prefix, phrase, pa.array(k[lo:hi], pa.int32()), pa.array(n[lo:hi], pa.int64())], names=_RUN_NAMES
            )


_RUN_NAMES = ["lang", "prefix", "phrase", "words", "f"]
_RUN = "lang string, prefix binary, phrase binary, words int, f long"


# --- chunks of text -------------------------------------------------------------------------


def _sections(batches) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(languages, bytes, offsets) of about ``CHUNK_BYTES``.  A longer text is
    cut at breaks, over which no phrase reaches."""
    for chunk in T.chunks(batches):
        data, off = T.utf8(chunk.column("text"))
        langs = chunk.column("lang").to_pylist()
        if len(langs) > 1 or len(data) <= T.CHUNK_BYTES:
            yield langs, data, off
            continue
        at = 0
        while at < len(data):
            stop = min(len(data), at + T.CHUNK_BYTES)
            while stop < len(data):  # to the next break
                found = np.flatnonzero(_BREAK[data[stop : stop + T.PIECE]])
                stop = min(len(data), stop + (int(found[0]) + 1 if len(found) else T.PIECE))
                if len(found):
                    break
            yield langs, data[at:stop], np.array([0, stop - at])
            at = stop


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """The hash of every word with the word behind it."""
    return T.window_hashes(h, 2)


def _lang_seed(lang: str) -> np.uint64:
    w = T.words(np.frombuffer(lang.encode() or b" ", np.uint8), np.array([0, len(lang.encode() or b" ")]), np.ones(256, bool))
    return T.word_hashes(w)[0]


class Filter:
    """Bits of the hashes that may be frequent, by their first bits."""

    def __init__(self, bits: bytes) -> None:
        self.bits = np.frombuffer(bits, np.uint8)
        self.shift = np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _told(batches) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """(language, word hashes, whether the next word is a neighbour, word
    starts, word ends, bytes) per language of every section."""
    for langs, data, off in _sections(batches):
        w = T.words(data, off, _WORD, lower=True)
        if not len(w.start):
            continue
        hashes = T.word_hashes(w)
        piece = np.cumsum(_BREAK[w.data])[w.start]
        text = w.text_of_word()
        together = np.zeros(len(hashes), bool)
        together[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        raw = w.data.tobytes()
        groups: dict[str, list[int]] = {}
        for k, lang in enumerate(langs):
            groups.setdefault("und" if lang is None else lang, []).append(k)
        for lang, texts in groups.items():
            own = np.concatenate([np.arange(w.first[k], w.first[k + 1]) for k in texts]) if len(groups) > 1 else slice(None)
            if len(hashes[own]):
                # a word's neighbour is of the same text, so it is the next of the language's as well
                yield lang, hashes[own], together[own][:-1], w.start[own], w.end[own], raw


def _seeded(hashes: np.ndarray, lang: str) -> np.ndarray:
    return T.mix64(hashes ^ _lang_seed(lang))


def _counted(docs: DataFrame, width: int, least: int, pairs, held: int, burst: int) -> DataFrame:
    """The runs of all tasks: of words (width 1), or of phrases of pairs that
    the filter ``pairs`` has."""

    def run(batches):
        counter = Counter(width, least, held, burst)
        known = None if pairs is None else Filter(pairs.value)
        totals: dict[str, int] = {}
        for lang, hashes, near, start, end, raw in _told(batches):
            n = len(hashes)
            reach = np.ones(n, np.int64)  # words from each word on that hang together, at most ``width``
            if known is None:
                totals[lang] = totals.get(lang, 0) + n
            else:
                at = np.flatnonzero(near)
                ok = np.zeros(n + width, bool)
                ok[at] = known.has(_seeded(pair_hashes(hashes)[at], lang))
                more = ok[:n].copy()
                for k in range(1, width):
                    reach += more
                    more &= ok[k : n + k]
            begin = np.flatnonzero(reach >= least)
            if not len(begin):
                continue
            used = np.zeros(n + width, bool)
            for k in range(width):
                used[begin[reach[begin] > k] + k] = True
            at = np.flatnonzero(used)
            own, first, which = np.unique(hashes[at], return_index=True, return_inverse=True)
            spots = at[first]
            ids = np.zeros(n + width, np.uint32)
            ids[at] = counter.id_of([raw[a:b] for a, b in zip(start[spots].tolist(), end[spots].tolist())])[which]
            paths = np.stack([np.where(reach[begin] > k, ids[begin + k], 0) for k in range(width)], 1).astype(np.uint32)
            yield from counter.add(lang, paths)
        yield from counter.flush()
        if totals:
            names = list(totals)
            none = pa.nulls(len(names), pa.binary())
            columns = [pa.array(names, pa.string()), none, none, pa.array([0] * len(names), pa.int32()), pa.array(list(totals.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=_RUN_NAMES)

    return docs.mapInArrow(run, _RUN)


# --- merged counts ------------------------------------------------------------------------


def _merged(runs: DataFrame, min_count: int) -> DataFrame:
    """The runs merged per prefix partition; phrases of at least ``min_count``
    occurrences, and the languages' word totals."""
    merged = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "phrase").agg(F.max("words").alias("words"), F.sum("f").alias("f"))
    return written(merged.filter((F.col("f") >= min_count) | F.col("phrase").isNull()).drop("prefix"), "phrase-counts")


def _filter(hashes: DataFrame, max_bits: int):
    """The bits of the hashes (column h), made in slices."""
    spark = hashes.sparkSession
    n, bits = hashes.count(), SLICE_BITS
    while bits < min(max_bits, 32 * n):
        bits *= 2
    shift = 64 - bits.bit_length() + 1

    def slices(key, table):
        own = np.zeros(SLICE_BITS, np.uint8)
        own[table.column("at").to_numpy() % SLICE_BITS] = 1
        packed = np.packbits(own, bitorder="little").tobytes()
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([packed], pa.binary())})

    at = hashes.select(F.shiftrightunsigned("h", shift).alias("at")).distinct()
    made = at.groupBy(F.floor(F.col("at") / SLICE_BITS).alias("slice")).applyInArrow(slices, "slice long, bits binary")
    whole = bytearray(bits // 8)
    for r in made.toLocalIterator():  # at most max_bits / 8 bytes in all
        whole[r.slice * SLICE_BITS // 8 : (r.slice + 1) * SLICE_BITS // 8] = r.bits
    return spark.sparkContext.broadcast(bytes(whole))


def _word_hashes(words: DataFrame) -> DataFrame:
    """The hashes (h) of (lang, phrase) rows of single words."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data, off = T.utf8(batch.column("phrase").cast(pa.string()))
            h = T.word_hashes(T.words(data, off, _WORD))
            langs = batch.column("lang").to_pylist()
            seeds = {x: _lang_seed(x) for x in set(langs)}
            h = T.mix64(h ^ np.array([seeds[x] for x in langs], np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return words.select("lang", "phrase").mapInArrow(run, "h long")


def _pair_hashes(docs: DataFrame, words, n_words: int, min_count: int) -> DataFrame:
    """The hashes (h; their first 40 bits and more) that pairs of neighbours
    with at least ``min_count`` occurrences can have.

    Tasks send sorted hashes with counts, packed, to the partition of the
    hash's first bits, where all counts of a hash meet; a partition has the
    hashes of about ``PART_PAIRS`` neighbours, however large the corpus."""
    first = max(6, min(20, (n_words // PART_PAIRS).bit_length()))
    low = 64 - first - 40

    def packed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        h, n = _summed(np.concatenate(hashes), np.concatenate(counts))
        part = (h >> np.uint64(64 - first)).astype(np.int64)
        names, at = np.unique(part, return_index=True)
        rest = np.ascontiguousarray(h >> np.uint64(low)).view(np.uint8).reshape(-1, 8)[:, :5]
        ends = [*at[1:].tolist(), len(h)]
        keys = [rest[a:b].T.tobytes() for a, b in zip(at.tolist(), ends)]  # byte by byte: the first bytes repeat
        sums = [n[a:b].astype(np.uint32).tobytes() for a, b in zip(at.tolist(), ends)]
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(keys, pa.binary()), pa.array(sums, pa.binary())], names=["part", "keys", "counts"])

    def run(batches):
        known, hashes, counts, held = Filter(words.value), [], [], 0
        for lang, h, near, *_ in _told(batches):
            may = known.has(_seeded(h, lang))
            at = np.flatnonzero(near & may[:-1] & may[1:])
            if not len(at):
                continue
            own, n = np.unique(_seeded(pair_hashes(h)[at], lang), return_counts=True)
            hashes.append(own)
            counts.append(n)
            held += len(own)
            if held > PAIRS_HELD:
                own, n = _summed(np.concatenate(hashes), np.concatenate(counts))
                hashes, counts, held = [own], [n], len(own)
                if held > PAIRS_HELD // 2:
                    yield packed(hashes, counts)
                    hashes, counts, held = [], [], 0
        if held:
            yield packed(hashes, counts)

    def merged(key, table):
        keys = [np.frombuffer(k, np.uint8).reshape(5, -1).T for k in table.column("keys").to_pylist()]
        wide = np.zeros((sum(map(len, keys)), 8), np.uint8)
        wide[:, :5] = np.concatenate(keys)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32).astype(np.int64)
        h, n = _summed(wide.view(np.uint64).ravel(), counts)
        h = (h[n >= min_count] << np.uint64(low)) | np.uint64(key[0].as_py()) << np.uint64(64 - first)
        return pa.table({"h": pa.array(h.view(np.int64))})

    runs = docs.mapInArrow(run, "part long, keys binary, counts binary")
    return written(runs.groupBy("part").applyInArrow(merged, "h long"), "phrase-pairs")


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes with the sums of their counts."""
    if not len(hashes):
        return hashes, counts
    by = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[by], counts[by]
    at = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[at], np.add.reduceat(counts, at)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100, max_words: int = 5, held: int = HELD, burst: int = BURST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of 1 to ``max_words`` words with
    f >= ``min_count``, and a row per language with null phrase: all words."""
    ship(docs.sparkSession)
    told = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    out = _merged(_counted(told, 1, 1, None, held, burst), min_count)
    if max_words >= 2:
        n_words = out.filter("phrase is null").agg(F.sum("f")).first()[0] or 0
        words = _filter(_word_hashes(out.filter("words = 1")), filter_bits)
        pairs = _filter(_pair_hashes(told, words, n_words, min_count), filter_bits)
        out = out.union(_merged(_counted(told, max_words, 2, pairs, held, burst), min_count))
    return out.withColumn("phrase", F.col("phrase").cast("string"))


def _part(start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice("w", F.lit(start) if isinstance(start, int) else start, size), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100, max_words: int = 5, percent: int = 100, top: int = 2000, **counting: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases
    by score, then count, both falling, then phrase by its bytes.

    Products are decimals of 38 digits: exact for counts below 10^15."""
    counts = phrase_counts(docs, text_col, lang_col, min_count, max_words, **counting)
    known = written(counts, "phrase-all")
    totals = known.filter("phrase is null").select("lang", F.col("f").alias("n"))
    phrases = known.filter("words >= 2").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))
    parts = known.filter("phrase is not null").select("lang", "phrase", "f")
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    left, right = parts.withColumnsRenamed({"phrase": "first", "f": "l"}), parts.withColumnsRenamed({"phrase": "rest", "f": "r"})
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    exact = "(cast(a as decimal(15,0)) * 1000 * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("best")
    scored = joined.groupBy("lang", "phrase", "a", "n").agg(lowest)
    inner = F.explode(F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))"))
    longer = phrases.filter(F.size("w") > 2).select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_a"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("_a").isNull() | (F.col("_a") * 100 < F.col("a") * percent))
    rows = kept.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
