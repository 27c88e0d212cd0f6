"""Benchmark decontamination with suffix arrays over the training texts.

Each chunk of training texts (a shard) gets a word-level suffix array: the
start positions of its suffixes in the order of their word sequences.  Every
suffix of every benchmark item is binary-searched in every shard, which puts
both in one order: the longest match of a text's suffix of up to ``window``
words is with the benchmark suffix before or after it.  The text's suffixes
that share a benchmark window are one range of the array, which gives all
locations of the window; windows that follow each other in text and item make
the longer matches, to their full length.

The benchmark goes to every task in parts of at most ``PART_BYTES`` of text
(or one item's), of any number; a task holds one part at a time and merges what
each finds.  The training texts are read once and never shuffled.  A shard holds about 4 MB of text
or one text.  Suffixes whose first word occurs in no benchmark item cannot
match and are left out of the array; the others are sorted two words at a
time, and only ties are sorted on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.llm import text as tx
from wardstat.llm.ship import ship

WINDOW = 13
PART_BYTES = 16 << 20  # benchmark text in a task at a time


@dataclass
class Probes:
    """Benchmark items: word hashes with a 0 after each item, the windows
    (start, length, item number), the items' ids, and all suffixes in order
    (start, words up to ``window``, item number)."""

    words: np.ndarray
    vocabulary: np.ndarray
    start: np.ndarray
    length: np.ndarray
    item: np.ndarray
    ids: list[str | None]
    suffix: np.ndarray
    rest: np.ndarray
    owner: np.ndarray


def normal_words(column: pa.Array) -> tuple[tx.Words, np.ndarray]:
    w = tx.words(*tx.utf8(column), table=tx.LOWER_ALNUM, lower=True)
    return w, tx.word_hashes(w)


def probes(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Probes:
    """The benchmark's windows.  Items without words have none; rows that
    repeat an id add their windows to it; rows without an id are one item, the
    last, whose name is null."""
    rows = benchmark.select(F.col(id_col).cast("string"), text_col).collect()  # a part of benchmark_parts
    rows.sort(key=lambda r: (r[0] is None, r[0] or "", r[1] or ""))
    ids = sorted({r[0] for r in rows}, key=lambda x: (x is None, x or ""))
    number = {x: i for i, x in enumerate(ids)}
    w, h = normal_words(pa.array([r[1] for r in rows], pa.large_string()))
    parts, start, length, item, at = [], [], [], [], 0
    rest, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, r in enumerate(rows):
        own = h[w.first[i] : w.first[i + 1]]
        if not len(own):
            continue
        n = max(1, len(own) - window + 1)
        start += range(at, at + n)
        length += [min(window, len(own))] * n
        item += [number[r[0]]] * n
        parts += [own, np.zeros(1, np.uint64)]
        rest.append(np.minimum(np.arange(len(own), -1, -1), window))
        owner.append(np.full(len(own) + 1, number[r[0]]))
        at += len(own) + 1
    words = np.concatenate([*parts, np.zeros(window, np.uint64)])
    ints = [np.array(x, np.int64) for x in (start, length, item)]
    suffix = suffix_array(words, np.flatnonzero(words), window)
    return Probes(words, np.unique(words[words != 0]), *ints, ids, suffix, np.concatenate(rest)[suffix], np.concatenate(owner)[suffix])


def benchmark_parts(benchmark: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark's distinct rows in parts by their hash, as many as it
    takes for each to have ``PART_BYTES`` of text at most, or a single row."""
    size = benchmark.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    if size <= PART_BYTES:
        return [benchmark]
    rows, n = benchmark.select(F.col(id_col).cast("string"), text_col).distinct(), -(-size // PART_BYTES)
    for _ in range(48):
        part = F.pmod(F.xxhash64(id_col, text_col), F.lit(n))
        sizes = rows.groupBy(part.alias("part")).agg(F.sum(F.octet_length(text_col)).alias("size"), F.count("*").alias("rows"))
        if sizes.filter((F.col("size") > PART_BYTES) & (F.col("rows") > 1)).isEmpty():
            return [rows.filter(part == F.lit(k)) for k in range(n)]
        n += -(-n // 2)
    raise ValueError("the benchmark does not divide into parts")


def suffix_array(h: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` in the order of the ``depth`` words from each on, words
    ordered by hash.  ``h`` has ``depth`` zeros at its end."""
    if not len(positions):
        return positions
    positions = positions[np.argsort(h[positions], kind="stable")]
    group = np.zeros(len(positions), np.int64)
    k = h[positions]
    group[1:] = np.cumsum(k[1:] != k[:-1])
    for d in range(1, depth):
        # members of groups of two and more; the others are in place
        tied = np.zeros(len(positions), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        k = h[positions[at] + d]
        order = np.lexsort((k, group[at]))
        positions[at] = positions[at[order]]
        k = k[order]
        # split the groups; numbers only need to differ between neighbours
        new = np.zeros(len(positions), bool)
        new[1:] = group[1:] != group[:-1]
        g = group[at]
        new[at[1:]] |= (g[1:] == g[:-1]) & (k[1:] != k[:-1])
        group = np.cumsum(new)
    return positions


def _compare(h: np.ndarray, suffix: np.ndarray, probe_words: np.ndarray, start: np.ndarray, length: np.ndarray, depth: int):
    """Per pair: -1, 0, 1 as the suffix's first ``length`` words are below,
    the same as, or above the probe's; and how many words agree."""
    sign = np.zeros(len(suffix), np.int8)
    agree = np.zeros(len(suffix), np.int64)
    open_ = np.arange(len(suffix))
    for d in range(depth):
        open_ = open_[length[open_] > d]
        if not len(open_):
            break
        a, b = h[suffix[open_] + d], probe_words[start[open_] + d]
        same = a == b
        sign[open_[~same]] = np.where(a[~same] < b[~same], -1, 1)
        open_ = open_[same]
        agree[open_] += 1
    return sign, agree


def _bound(h, array, words: np.ndarray, start: np.ndarray, length: np.ndarray, depth: int, upper: bool) -> np.ndarray:
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(array), np.int64)
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        sign, _ = _compare(h, array[mid], words, start[open_], length[open_], depth)
        right = sign <= 0 if upper else sign < 0
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]


@dataclass
class Longest:
    """Per document the longest match: words, first word (-1 if none) and item
    number."""

    words: np.ndarray
    at: np.ndarray
    item: np.ndarray

    def offer(self, doc: np.ndarray, words: np.ndarray, at: np.ndarray, item: np.ndarray) -> None:
        """Takes over what is longer; the first place of equals."""
        order = np.lexsort((item, at, -words, doc))
        order = order[np.concatenate(([True], doc[order][1:] != doc[order][:-1]))] if len(order) else order
        order = order[words[order] > self.words[doc[order]]]
        d = doc[order]
        self.words[d], self.at[d], self.item[d] = words[order], at[order], item[order]


def _short_matches(h: np.ndarray, array: np.ndarray, p: Probes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix of the shard: the words it shares with a benchmark suffix,
    ``window`` at most, and that suffix's item."""
    best, item = np.zeros(len(array), np.int64), np.zeros(len(array), np.int64)
    if not len(p.suffix):
        return best, item
    # both orders run over the same word sequences, ends of texts and items included
    below = _bound(h, array, p.words, p.suffix, np.full(len(p.suffix), window), window, False)
    after = np.searchsorted(below, np.arange(len(array)), side="right")
    for side in (np.maximum(after - 1, 0), np.minimum(after, len(p.suffix) - 1)):
        _, agree = _compare(h, array, p.words, p.suffix[side], p.rest[side], window)
        more = agree > best
        best[more], item[more] = agree[more], p.owner[side[more]]
    return best, item


def search(w: tx.Words, hashes: np.ndarray, p: Probes, window: int):
    """All occurrences (word position, words, item, document) of the probes'
    windows in a shard, and each document's longest verbatim match with its
    position, of ``window`` words at most and in full with its item."""
    n_docs = len(w.first) - 1
    # one 0 after each text keeps matches inside it
    h = np.zeros(len(hashes) + n_docs + window + 1, np.uint64)
    shift = w.text_of_word()
    h[np.arange(len(hashes)) + shift] = hashes
    known = np.isin(hashes, p.vocabulary)
    positions = np.flatnonzero(known) + shift[known]
    array = suffix_array(h, positions, window)
    lower = _bound(h, array, p.words, p.start, p.length, window, False)
    upper = _bound(h, array, p.words, p.start, p.length, window, True)
    start_of = w.first[:-1] + np.arange(n_docs)
    doc_of = lambda at: np.searchsorted(start_of, at, side="right") - 1
    full = Longest(np.zeros(n_docs, np.int64), np.full(n_docs, -1, np.int64), np.full(n_docs, -1, np.int64))
    best, item = _short_matches(h, array, p, window)
    doc = doc_of(array)
    full.offer(doc, best, array - start_of[doc], item)
    longest, where = full.words.copy(), full.at.copy()
    count = upper - lower
    hit = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
    at = array[lower[hit] + step] if len(hit) else np.zeros(0, np.int64)
    # hits that follow each other in text and item are one match
    whole = np.flatnonzero(p.length[hit] == window)
    order = whole[np.lexsort((at[whole], at[whole] - p.start[hit[whole]]))]
    if len(order):
        a, q = at[order], p.start[hit[order]]
        begin = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1] + 1) | (q[1:] != q[:-1] + 1))))
        words = np.diff(np.concatenate((begin, [len(a)]))) + window - 1
        doc = doc_of(a[begin])
        full.offer(doc, words, a[begin] - start_of[doc], p.item[hit[order[begin]]])
    # back to positions without the separators
    doc = doc_of(at)
    return at - doc, p.length[hit], p.item[hit], doc, longest, where, full


class Found:
    """What a shard's documents share with the parts of the benchmark seen so
    far."""

    def __init__(self, n_docs: int):
        self.items: list[set[str | None]] = [set() for _ in range(n_docs)]
        self.longest = np.zeros(n_docs, np.int64)
        self.where = np.full(n_docs, -1, np.int64)
        self.words, self.at = self.longest.copy(), self.where.copy()
        self.item: list[str | None] = [None] * n_docs
        self.covered: np.ndarray | None = None

    def add(self, w: tx.Words, hashes: np.ndarray, p: Probes, window: int) -> None:
        at, length, item, doc, longest, where, full = search(w, hashes, p, window)
        # covered words, by starts and ends of windows
        edge = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        covered = np.cumsum(edge[:-1]) > 0
        self.covered = covered if self.covered is None else self.covered | covered
        self.first, self.owner = w.first, w.text_of_word()
        for x in np.unique(doc * len(p.ids) + item) if len(doc) else []:  # items of a chunk's contaminated documents only
            self.items[int(x) // len(p.ids)].add(p.ids[int(x) % len(p.ids)])
        better = (longest > self.longest) | ((longest == self.longest) & (where < self.where))
        self.longest[better], self.where[better] = longest[better], where[better]
        for d in np.flatnonzero((full.words > 0) & (full.words >= self.words)):
            name = p.ids[full.item[d]]
            new = (-full.words[d], full.at[d], name is None, name or "")
            if not self.words[d] or new < (-self.words[d], self.at[d], self.item[d] is None, self.item[d] or ""):
                self.words[d], self.at[d], self.item[d] = full.words[d], full.at[d], name

    def columns(self) -> list[pa.Array]:
        """``n_words`` to ``match_item``."""
        covered, first, owner = self.covered, self.first, self.owner
        sums = np.concatenate(([0], np.cumsum(covered)))
        spans: list[list[dict]] = [[] for _ in self.items]
        if covered.any():
            begin, finish = covered.copy(), covered.copy()
            begin[1:] &= ~covered[:-1] | (owner[1:] != owner[:-1])
            finish[:-1] &= ~covered[1:] | (owner[1:] != owner[:-1])
            for s, e in zip(np.flatnonzero(begin), np.flatnonzero(finish), strict=True):
                spans[owner[s]].append({"first": int(s - first[owner[s]]), "words": int(e - s + 1)})
        items = [sorted(x, key=lambda name: (name is None, name or "")) for x in self.items]
        return [
            pa.array(np.diff(first)), pa.array(sums[first[1:]] - sums[first[:-1]]), pa.array(items, pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))),
            pa.array(self.longest), pa.array(self.where), pa.array(self.words), pa.array(self.at), pa.array(self.item, pa.string()),
        ]


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every row with what it shares with the benchmark.

    Adds ``n_words``, ``n_hit`` (words inside an occurring window), ``items``
    (ids with an occurring window, as strings in string order, a null for items without id), ``spans``
    (first word and number of words of each maximal hit stretch), and the
    longest run of words that is also in an item, the first of equals:
    ``match_words``, ``match_at`` (its first word, -1 if none) and
    ``match_item`` (an item that holds it).  ``longest`` and ``longest_at``
    are the same for matches cut to ``window`` words.
    Windows are ``window`` consecutive words; an item of fewer words is one
    window.  Words are runs of a-z, 0-9 and everything beyond ASCII, after
    lower-casing A-Z.  Null and empty texts have no words.  ``keep`` names
    the columns to pass on (all by default, but for clashing names).
    """
    ship(docs.sparkSession)
    added = T._parse_datatype_string(
        "n_words long, n_hit long, items array<string>, spans array<struct<first:long,words:long>>, longest long, longest_at long, "
        "match_words long, match_at long, match_item string"
    )
    names = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    send = docs.sparkSession.sparkContext.broadcast
    parts = [send(probes(x, item_col, item_text_col, window)) for x in benchmark_parts(benchmark, item_col, item_text_col)]
    schema = T.StructType([docs.schema[c] for c in names] + added.fields)

    def run(batches):
        for batch in batches:
            shards = list(tx.chunks([batch], text_col))
            found = [Found(len(b)) for b in shards]
            for p in parts:
                for b, f in zip(shards, found, strict=True):
                    f.add(*normal_words(b.column(text_col)), p.value, window)
                if len(parts) > 1:
                    vars(p).pop("_value", None)  # the worker would keep every part; it is read from disk again
            for b, f in zip(shards, found, strict=True):
                yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + f.columns(), names=names + added.names)

    columns = list(dict.fromkeys([*names, text_col]))
    return docs.select(*columns).mapInArrow(run, schema)


def contaminated() -> Column:
    """At least one hit word, and at least a twentieth of all words hit."""
    return F.expr("n_hit > 0 and 20 * n_hit >= n_words")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, with their own columns."""
    clash = [c for c in ("n_words", "n_hit", "items", "spans", "longest", "longest_at", "match_words", "match_at", "match_item") if c in docs.columns]
    renamed = docs.withColumnsRenamed({c: f"_own_{c}" for c in clash})
    left = overlaps(renamed, benchmark, **options).filter(~contaminated())
    return left.select(*[F.col(f"_own_{c}" if c in clash else c).alias(c) for c in docs.columns])

