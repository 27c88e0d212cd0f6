"""Documents scored by an n-gram language model with stupid backoff.

S(w | context) = c(context w) / c(context) if the n-gram occurs ``min_count``
times or more, else ALPHA * S(w | context without its first word); a word
alone has c(w) / N.  Counts are over all texts of the corpus, every n-gram
counts.  A document's score is the mean of log S over its words.

Relationally this is: explode every text into n-grams, count them in tables
partitioned by hash, join the counts back to the occurrences, sum per
document.  Rows of single n-grams would be many times the text, so a row here
is a packed array of the distinct n-grams that one chunk of texts has in one
hash partition.

1. Each chunk sends its distinct n-grams of all orders, with their counts, to
   the partitions of their hashes.
2. A partition sums the counts and answers each row with the totals, in the
   row's order.
3. The texts are read again, in the same chunks, and each chunk sends a plan:
   its documents and its words by number.  Plan and answers meet by chunk,
   where the n-grams are put together again from the numbers; each word takes
   the longest n-gram that is known.  A sum over the chunk's n-grams travels
   with the answers, so texts that differ when read again are an error.

An n-gram is one entry per chunk wherever it goes, so neither a word nor a
phrase in a third of all positions makes a partition or a row long, and no
documents travel to the counts.  A miss falls back to the shorter n-gram, whose
count came by the same partitions.  Partitions are ranges of 56-bit hashes, the
number of which follows the number of words.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.llm import text as tx
from wardstat.llm.near_dup import _groups
from wardstat.llm.ship import ship

ALPHA = 0.4
ORDER = 3
PART_WORDS = 500_000  # words of the corpus for each hash partition, about
CHUNK_BYTES = 6 << 20  # text bytes of a chunk; a longer text is a chunk of its own
KEY_BITS = np.uint64(56)

SHAPE = "part long, kind int, chunk long, data binary"
PLAN, COUNT, ASK = 0, 1, 2  # rows of documents, of n-grams to count, of n-grams to answer


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit integers as byte planes, as many as the largest needs,
    compressed."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a).astype(np.int64, copy=False).view(np.uint64)
        size = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        out += [struct.pack("<BQ", size, len(a)), np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()]
    raw = b"".join(out)
    return struct.pack("<Q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: pa.Buffer) -> list[np.ndarray]:
    raw = memoryview(pa.decompress(packed[8:], struct.unpack_from("<Q", packed)[0], codec="zstd"))
    at, out = 0, []
    while at < len(raw):
        size, n = struct.unpack_from("<BQ", raw, at)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :size] = np.frombuffer(raw, np.uint8, n * size, at + 9).reshape(size, n).T
        out.append(wide.reshape(-1).view(np.int64))
        at += 9 + n * size
    return out


def _column(values: pa.Array) -> bytes:
    """A column of any type, as bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("id", values.type)])) as out:
        out.write_batch(pa.RecordBatch.from_arrays([values], names=["id"]))
    return sink.getvalue().to_pybytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    cols = zip(*rows, strict=True) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["part", "kind", "chunk", "data"])


class Grams:
    """The distinct n-grams of a chunk, from the numbers of its words.

    ``at[k]`` numbers the n-gram of k + 1 words from each position on (where
    the text has so many words left); ``order`` sorts all keys."""

    def __init__(self, number: np.ndarray, hashes: np.ndarray, counts: np.ndarray, order: int):
        ends = np.repeat(np.cumsum(counts), counts)
        self.left = ends - np.arange(len(number))  # words left in the text, this one too
        self.at, self.sizes, names = [number], [len(hashes)], [hashes]
        own = hashes
        for k in range(2, order + 1):
            start = np.flatnonzero(self.left >= k)
            code, distinct = pd.factorize(self.at[-1][start] * max(len(hashes), 1) + number[start + k - 1])
            before, last = np.divmod(distinct, max(len(hashes), 1))
            own = tx.mix64(own[before] * np.uint64(0x9E3779B97F4A7C15) + hashes[last])
            full = np.zeros(len(number), np.int64)
            full[start] = code
            self.at.append(full)
            self.sizes.append(len(distinct))
            names.append(own)
        self.keys = np.concatenate(names) >> (np.uint64(64) - KEY_BITS)
        self.order = np.argsort(self.keys, kind="stable")

    def counts(self) -> np.ndarray:
        """How often each n-gram occurs in the chunk."""
        return np.concatenate([np.bincount(a[self.left > k], minlength=n) for k, (a, n) in enumerate(zip(self.at, self.sizes, strict=True))])

    def check(self) -> int:
        return int(np.bitwise_xor.reduce(tx.mix64(self.keys))) & 0xFFFFFFFF

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        """Values in the order of the sorted keys, by n-gram length."""
        back = np.empty(len(values), values.dtype)
        back[self.order] = values
        return np.split(back, np.cumsum(self.sizes)[:-1])


def _words(docs: DataFrame, text_col: str) -> int:
    def count(batches):
        n = sum(len(tx.words(*tx.utf8(b.column(text_col))).start) for b in tx.chunks(batches, text_col))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return docs.select(text_col).mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


def _chunks(batches, text_col: str) -> Iterator[tuple]:
    """(number, rows, their word counts, distinct word hashes, words by
    number) of each chunk; the number is the same whenever the task runs."""
    task = TaskContext.get().partitionId()
    for k, b in enumerate(tx.chunks(batches, text_col, CHUNK_BYTES)):
        w = tx.words(*tx.utf8(b.column(text_col)))
        number, hashes = pd.factorize(tx.word_hashes(w))
        yield (task << 32) | k, b, w.counts, hashes, number


def _grams(docs: DataFrame, text_col: str, parts: int, order: int, kind: int, counted: bool) -> DataFrame:
    """Rows to the partitions: every chunk's n-grams."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for chunk, _, counts, hashes, number in _chunks(batches, text_col):
            if not len(number):
                continue
            grams = Grams(number, hashes, counts, order)
            keys, n = grams.keys[grams.order], grams.counts()[grams.order]
            if not counted:
                n = np.zeros(len(keys), np.int64)
            to = ((keys >> (KEY_BITS - np.uint64(32))) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            edges = np.concatenate((np.flatnonzero(np.diff(to, prepend=-1)), [len(to)]))
            keys, check = keys.view(np.int64), np.array([grams.check()])
            yield _batch(
                [
                    (int(to[a]), kind, chunk, pack(keys[a : a + 1], np.diff(keys[a:z]), n[a:z], check if a == 0 else check[:0]))
                    for a, z in zip(edges[:-1], edges[1:], strict=True)
                ]
            )

    return docs.mapInArrow(run, SHAPE)


def _plans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per chunk: its ids, and its words by number."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for chunk, b, counts, hashes, number in _chunks(batches, text_col):
            plan = pack(counts, hashes.view(np.int64), number)
            yield _batch([(-1, PLAN, chunk, struct.pack("<Q", len(plan)) + plan + _column(b.column(id_col)))])

    return docs.mapInArrow(run, SHAPE)


def _totals(rows: DataFrame) -> DataFrame:
    """For each row that asks the totals of its n-grams."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 1):
            g = g.combine_chunks()
            part = g.column("part")[0].as_py()
            kinds, chunks = g.column("kind").to_numpy(), g.column("chunk").to_numpy()
            keys, counts, checks = [], [], []
            for x in g.column("data").combine_chunks():
                first, steps, n, check = unpack(x.as_buffer())
                keys.append(np.cumsum(np.concatenate((first, steps))))
                counts.append(n)
                checks.append(check)
            edge = np.concatenate(([0], np.cumsum([len(x) for x in keys])))
            gram, names = pd.factorize(np.concatenate(keys))
            del keys
            total = np.bincount(gram, np.concatenate(counts), minlength=len(names)).astype(np.int64)[gram]
            del gram, names, counts
            yield _batch([(part, ASK, int(chunks[i]), pack(total[edge[i] : edge[i + 1]], checks[i])) for i in np.flatnonzero(kinds == ASK)])

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, SHAPE)


def _log_scores(grams: Grams, totals: list[np.ndarray], counts: np.ndarray, n_all: int, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """log S of every word, and by how many orders it backed off."""
    place = np.repeat(counts, counts) - grams.left
    most = np.minimum(place, len(totals) - 1)  # words of context there could be
    log_s = np.log(np.maximum(totals[0][grams.at[0]], 1) / max(n_all, 1))
    short = most.copy()
    for k in range(1, len(totals)):
        start = np.flatnonzero(grams.left > k)
        c = totals[k][grams.at[k][start]]
        known = c >= max(min_count, 1)
        start, c = start[known], c[known]
        log_s[start + k] = np.log(c / totals[k - 1][grams.at[k - 1][start]])
        short[start + k] = most[start + k] - k
    return log_s + short * np.log(ALPHA), short


def stupid_backoff(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = 1, order: int = ORDER, corpus: DataFrame | None = None
) -> DataFrame:
    """(id, n_words, n_backoff, score) per row: how many words backed off to a
    shorter context than their place in the text allows, and the mean log S
    per word.

    Counts come from ``corpus`` (``docs`` itself by default; then an n-gram
    backs off only below ``min_count``).  A word that the corpus does not have
    counts as if it were there once.  Words are runs without ASCII white space,
    unchanged.  Null and empty texts have 0 words and a null score; rows that
    share an id are scored each for itself; ids may be null and of any type;
    extra columns are ignored; an empty table gives no rows.  ``docs`` is read
    twice and must give the same rows in the same order, as a stored table does.
    """
    ship(docs.sparkSession)
    docs = docs.select(id_col, text_col)  # both readings by one plan
    n_all = _words(docs if corpus is None else corpus, text_col)
    parts = int(max(1, -(-n_all // PART_WORDS)))
    rows = _grams(docs, text_col, parts, order, ASK, corpus is None)
    if corpus is not None:
        rows = rows.unionByName(_grams(corpus.select(text_col), text_col, parts, order, COUNT, True))

    def finish(batches):
        for g in _groups(batches, 1):
            data = g.combine_chunks().column("data").combine_chunks()  # the plan comes first, answers by partition
            raw = data[0].as_buffer()
            size = struct.unpack_from("<Q", raw)[0]
            n, hashes, number = unpack(raw.slice(8, size))
            ids = pa.ipc.open_stream(raw.slice(8 + size)).read_all().column(0).combine_chunks()
            score, off = np.zeros(len(n)), np.zeros(len(n), np.int64)
            if len(number):
                grams = Grams(number, hashes.view(np.uint64), n, order)
                answers = [unpack(x.as_buffer()) for x in data[1:]]
                if not answers or [grams.check()] != [c for _, check in answers for c in check.tolist()]:
                    raise ValueError("the texts were not the same when read again; write them to a table first")
                totals = grams.split(np.concatenate([total for total, _ in answers]))
                log_s, short = _log_scores(grams, totals, n, n_all, min_count)
                text_of = np.repeat(np.arange(len(n)), n)
                score = np.bincount(text_of, log_s, minlength=len(n)) / np.maximum(n, 1)
                off = np.bincount(text_of, short > 0, minlength=len(n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(off), pa.array(score, mask=n == 0)], names=[id_col, "n_words", "n_backoff", "score"])

    shape = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    shape = shape.add("n_words", "long").add("n_backoff", "long").add("score", "double")
    # the reader of the texts comes first in a union: a task's number is the union's
    every = _plans(docs, id_col, text_col).unionByName(_totals(rows))
    dealt = every.select("chunk", "kind", "part", "data").repartition("chunk").sortWithinPartitions("chunk", "kind", "part")
    return dealt.mapInArrow(finish, shape)
