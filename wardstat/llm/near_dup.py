"""Near-duplicate documents by fast similarity sketching.

A document is its set of distinct word shingles.  Its sketch has ``t``
coordinates filled by rounds of hashed bin placement: in round i < t every
shingle falls into one hashed bin with the value i + hash; in round t + j
every shingle falls into bin j.  A document stops at the first round after
which no bin is empty, so every coordinate is filled after 2t rounds at the
latest, most documents need one or two, and coordinates agree with the
Jaccard similarity's probability, with concentration like independent
permutations.

Bands of the sketch give buckets; candidates are confirmed on the full sets:

1. Documents with the same set are one class, found by a fingerprint.
2. A task that holds a band bucket compares sketches, whole arrays at a time,
   and returns a spanning forest of the pairs whose estimate is at most five
   standard deviations below the threshold: a star around one member, and
   for members outside it their comparison with all others.
3. The components of these forests are clusters of candidates.  A task that
   holds a cluster's full sets confirms links in the order of the estimates,
   skips pairs that are connected already, and returns a spanning forest of
   the links.  Their components are the result.

So no bucket emits its pairs, none is capped, and no link is lost between
members of a bucket (but for the estimate's five standard deviations).  A
bucket or cluster larger than a block is compared block by block, in as many
tasks as there are pairs of blocks.

Null or empty texts have an empty set and are linked with nothing, as are
rows whose id is null.  Rows that share an id count as one document with
several texts.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm import text as tx
from wardstat.llm.components import components, written
from wardstat.llm.ship import ship

ROWS, BANDS = 5, 25
BUCKET_BLOCK = 20_000  # members of a bucket that meet in one task
CLUSTER_BLOCK = 1_000  # members of a cluster whose sets meet in one task
SET_BYTES = 6  # a shingle's identity within a set: 48 bits
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
SEEDS = tx.mix64(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit shingles of every text, sorted, and where each text's
    begin.  A text with fewer than ``size`` words has its whole sequence as
    one shingle."""
    w = tx.words(*tx.utf8(column), lower=True)
    h = tx.word_hashes(w)
    n_docs = len(w.first) - 1
    at = tx.inside_one_text(w, size)
    doc = np.searchsorted(w.first, at, side="right") - 1
    value = tx.window_hashes(h, size)[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        whole = w.first[short]
        extra = h[whole].copy()
        for k in range(1, size - 1):
            longer = w.counts[short] > k
            extra[longer] = tx.mix64(extra[longer] * np.uint64(3) + h[whole[longer] + k])
        doc = np.concatenate((doc, short))
        value = np.concatenate((value, tx.mix64(extra + w.counts[short].astype(np.uint64))))
    # one sort for all: the document's number above the shingle's 48 bits
    key = (doc.astype(np.uint64) << np.uint64(48)) | (value >> np.uint64(16))
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    first = np.searchsorted(key, np.arange(n_docs + 1, dtype=np.uint64) << np.uint64(48))
    return key & np.uint64((1 << 48) - 1), first


def sketches(values: np.ndarray, first: np.ndarray, t: int) -> np.ndarray:
    """The sketch (row) of every set; a set without elements keeps the
    largest value everywhere."""
    n = len(first) - 1
    out = np.full((n, t), _MAX, np.uint64)
    flat = out.reshape(-1)
    sizes = np.diff(first)
    active = np.flatnonzero(sizes > 0)
    for i in range(2 * t):
        if not len(active):
            break
        if len(active) == n:
            rows, owner = values, np.repeat(active, sizes)
        else:
            count = sizes[active]
            owner = np.repeat(active, count)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            rows = values[first[owner] + step]
        h = tx.mix64(rows ^ SEEDS[i])
        value = (h & np.uint64(0xFFFFFFFF)) | np.uint64(i << 32)
        if i < t:
            slot = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            slot = i - t
        np.minimum.at(flat, owner * t + slot, value)
        active = active[(out[active] == _MAX).any(1)]
    return out


def band_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    keys = np.empty((len(sketch), bands), np.uint64)
    for b in range(bands):
        k = np.full(len(sketch), b + 1, np.uint64)
        for r in range(rows):
            k = tx.mix64(k * np.uint64(0x9E3779B97F4A7C15) + sketch[:, b * rows + r])
        keys[:, b] = k
    return keys


def _fingerprints(values: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set, independent of order."""
    out = []
    for seed in (0x1234567, 0x89ABCDEF12345):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tx.mix64(values ^ np.uint64(seed)))))
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out


def _signatures(docs: DataFrame, id_col: str, text_col: str, size: int, rows: int, bands: int) -> DataFrame:
    t = rows * bands
    schema = f"{id_col} long, n_shingles long, fp1 long, fp2 long, bands array<long>, sk binary"

    def run(batches):
        for b in tx.chunks(batches, text_col):
            values, first = shingle_sets(b.column(text_col), size)
            n = np.diff(first)
            sketch = sketches(values, first, t)
            keys = band_keys(sketch, rows, bands).view(np.int64)
            # a byte per coordinate is enough to estimate with
            low = tx.mix64(sketch.reshape(-1)).astype(np.uint8).tobytes()
            sk = pa.array([low[i : i + t] for i in range(0, len(low), t)], pa.binary())
            offsets = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[n > 0].reshape(-1)))
            fp1, fp2 = _fingerprints(values, first)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(pa.int64()), pa.array(n), pa.array(fp1), pa.array(fp2), lists, sk],
                names=[id_col, "n_shingles", "fp1", "fp2", "bands", "sk"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(rep, fp1, fp2, packed set) of every row."""

    def run(batches):
        for b in tx.chunks(batches, text_col):
            values, first = shingle_sets(b.column(text_col), size)
            packed = values.view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()
            offsets = (first * SET_BYTES).astype(np.int64)
            column = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed)])
            fp1, fp2 = _fingerprints(values, first)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(pa.int64()), pa.array(fp1), pa.array(fp2), column.cast(pa.binary())], names=["rep", "fp1", "fp2", "items"]
            )

    return docs.select(id_col, text_col).mapInArrow(run, "rep long, fp1 long, fp2 long, items binary")


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // SET_BYTES, 8), np.uint8)
    wide[:, :SET_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, SET_BYTES)
    return wide.view(np.uint64).reshape(-1)


def _groups(batches, keys: int) -> Iterator[pa.Table]:
    """Whole groups of rows that agree in the first ``keys`` columns, from
    batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) < 2000:
            continue
        table = pa.Table.from_batches(held)
        edges = _edges(table, keys)
        # the last group may go on in the next batch
        for lo, hi in zip(edges[:-2], edges[1:-1], strict=True):
            yield table.slice(lo, hi - lo)
        held = table.slice(edges[-2]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        edges = _edges(table, keys)
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            yield table.slice(lo, hi - lo)


def _edges(table: pa.Table, keys: int) -> list[int]:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in range(keys):
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return [*np.flatnonzero(new).tolist(), table.num_rows]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


class _Forest:
    """Union-find over the rows of a group."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: int, b: int) -> None:
        x, y = self.root[a], self.root[b]
        if x != y:
            self.root[self.root == max(x, y)] = min(x, y)
            self.links.append((a, b))


def _similar(n: np.ndarray, sk: np.ndarray, i: int, percent: int, least: float) -> np.ndarray:
    """Rows that may be linked with row ``i``."""
    size = np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent
    out = np.zeros(len(n), bool)
    at = np.flatnonzero(size)
    out[at] = (sk[at] == sk[i]).sum(1) >= least
    out[i] = False
    return out


def _candidates(members: DataFrame, width: int, percent: int, least: float) -> DataFrame:
    """Spanning forests (a, b) of the similar pairs of every bucket block pair."""

    def run(batches):
        for g in _groups(batches, 3):
            rep, n = g.column("rep").to_numpy(), g.column("n").to_numpy()
            sk = _matrix(g.column("sk"), width)
            if len(rep) == 2:  # most buckets
                ok = min(n) * 100 >= max(n) * percent and (sk[0] == sk[1]).sum() >= least
                pairs = [(0, 1)] if ok else []
            else:
                forest = _Forest(len(rep))
                star = np.flatnonzero(_similar(n, sk, 0, percent, least))
                for j in star.tolist():
                    forest.links.append((0, j))
                forest.root[star] = 0
                for i in np.flatnonzero(forest.root != 0).tolist():
                    near = np.flatnonzero(_similar(n, sk, i, percent, least) & (forest.root != forest.root[i]))
                    # one link per other component is enough
                    _, one = np.unique(forest.root[near], return_index=True)
                    for j in near[one].tolist():
                        forest.add(i, j)
                pairs = forest.links
            if pairs:
                a, b = np.array(pairs).T
                yield pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], names=["a", "b"])

    dealt = members.select("key", "lo", "hi", "rep", "n", "sk").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep")
    return dealt.mapInArrow(run, "a long, b long")


def _links(members: DataFrame, width: int, percent: int, least: float) -> DataFrame:
    """Spanning forests (a, b) of the confirmed links of every cluster block pair."""

    def run(batches):
        for g in _groups(batches, 3):
            rep, n = g.column("rep").to_numpy(), g.column("n").to_numpy()
            sk = _matrix(g.column("sk"), width)
            sets = [unpacked(x.as_buffer()) for x in g.column("items").combine_chunks()]
            size = np.array([len(x) for x in sets])
            first = np.concatenate(([0], np.cumsum(size)))
            number, names = pd.factorize(np.concatenate(sets))
            mark = np.zeros(len(names), bool)
            forest = _Forest(len(rep))
            order = np.argsort(-(sk == sk[0]).sum(1), kind="stable")  # the first row's neighbours first
            for i in order.tolist():
                near = np.flatnonzero(_similar(n, sk, i, percent, least) & (forest.root != forest.root[i]))
                if not len(near):
                    continue
                mark[number[first[i] : first[i + 1]]] = True
                at = np.repeat(first[near] - (np.cumsum(size[near]) - size[near]), size[near]) + np.arange(size[near].sum())
                both = np.add.reduceat(mark[number[at]].astype(np.int64), np.cumsum(size[near]) - size[near])
                mark[number[first[i] : first[i + 1]]] = False
                linked = near[100 * both >= percent * (size[i] + size[near] - both)]
                if len(linked):
                    _, one = np.unique(forest.root[linked], return_index=True)
                    for j in linked[one].tolist():
                        forest.add(i, j)
            if forest.links:
                a, b = np.array(forest.links).T
                yield pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], names=["a", "b"])

    dealt = members.select("cluster", "lo", "hi", "rep", "n", "sk", "items").repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "rep")
    return dealt.mapInArrow(run, "a long, b long")


def _blocked(members: DataFrame, count: str, block: int) -> DataFrame:
    """A row per pair of blocks (lo, hi) that a member meets others in; one
    for a group within a block."""
    blocks = F.ceil(F.col(count) / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    return (
        members.select("*", own.alias("own"), other)
        .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
        .drop("own", "other", count)
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row.

    ``component_id`` is the smallest id reachable over links between sets
    with 100 * intersection >= ``percent`` * union; ``kept`` marks the rows
    whose id it is.  With 25 bands of 5 rows a pair at similarity 0.8 is a
    candidate with probability 0.99995, at 0.85 with 0.9999996.
    """
    if rows * bands * 2 > len(SEEDS):
        raise ValueError(f"rows * bands can be at most {len(SEEDS) // 2}")
    ship(docs.sparkSession)
    t, p = rows * bands, percent / 100
    least = t * (p - 5 * (p * (1 - p) / t) ** 0.5)
    sig = written(_signatures(docs, id_col, text_col, shingle_words, rows, bands), "near-dup-signatures")
    classed = sig.filter(f"n_shingles > 0 and {id_col} is not null")
    # one representative per distinct set; the minimum combines map-side
    smallest = classed.groupBy("fp1", "fp2", "n_shingles").agg(F.min(id_col).alias("rep"))
    reps = written(smallest.join(sig.select(F.col(id_col).alias("rep"), "fp1", "fp2", "bands", "sk").dropDuplicates(["rep", "fp1", "fp2"]),
                                 ["rep", "fp1", "fp2"]).withColumnRenamed("n_shingles", "n"), "near-dup-classes")
    entries = reps.select("rep", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    sketch = reps.select("rep", "fp1", "fp2", "n", "sk")
    members = entries.join(shared, "key").join(sketch.drop("fp1", "fp2"), "rep")
    candidates = written(_candidates(_blocked(members, "members", BUCKET_BLOCK), t, percent, least), "near-dup-candidates")
    clusters = written(components(candidates).withColumnsRenamed({"node": "rep", "component": "cluster"}), "near-dup-clusters")
    # only documents of a cluster are read again
    wanted = clusters.select(F.col("rep").alias(id_col))
    sets = _sets(docs.select(id_col, text_col).join(wanted, id_col, "left_semi"), id_col, text_col, shingle_words)
    sized = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    one = sets.dropDuplicates(["rep", "fp1", "fp2"])  # rows that repeat an id and its text
    full = clusters.join(sized, "cluster").join(sketch, "rep").join(one, ["rep", "fp1", "fp2"])
    links = _links(_blocked(full, "members", CLUSTER_BLOCK), t, percent, least)
    labels = written(components(links), "near-dup-labels")

    joined = sig.drop("bands", "sk").join(smallest, ["fp1", "fp2", "n_shingles"], "left")
    named = joined.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    own = f"n_shingles = 0 or {id_col} is null"
    component = F.expr(f"case when {own} then {id_col} else coalesce(component, rep) end")
    return named.select(id_col, "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.expr(f"{id_col} is null or {id_col} = component_id"))
