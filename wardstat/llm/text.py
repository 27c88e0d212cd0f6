"""Words of UTF-8 texts as numpy arrays, straight from Arrow buffers.

A chunk of texts is one byte buffer with an offset per text.  Word edges
come from a 256-entry table of word bytes, word identities from a 64-bit
polynomial hash over mixed bytes; both are whole-array operations, so no
Python object is made for a word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE = 1 << 18  # bytes hashed at a time; keeps the 8-byte intermediates in cache
CHUNK_BYTES = 4 << 20  # text bytes handled at a time; a longer text is a chunk of its own

_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: words ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~_ASCII_SPACE
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (digits, a-z, everything beyond ASCII)
LOWER_ALNUM = np.zeros(256, bool)
LOWER_ALNUM[0x30:0x3A] = LOWER_ALNUM[0x61:0x7B] = LOWER_ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_P = 0x5851F42D4C957F2D
_P_INV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_P, PIECE + 1), _powers(_P_INV, PIECE + 1)


@dataclass
class Words:
    """Words of a chunk: byte edges, and for text ``t`` the words
    ``first[t]`` to ``first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about ``limit`` text bytes (at
    least one row)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < n:
            stop = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            stop = min(n, max(at + 1, stop))
            yield batch.slice(at, stop - at)
            at = stop


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Word edges.  ``lower`` lower-cases A-Z first (one byte for one byte)."""
    if lower:
        data = _LOWER[data]
    if not len(data):
        z = np.zeros(0, np.int64)
        return Words(data, z, z, np.zeros(len(offsets), np.int64))
    inside = table[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] |= inside[edge]
    ends[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets).astype(np.int64))


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of every word; never 0, which marks a text's end."""
    out = np.empty(len(w.start), U64)
    at, n = 0, len(w.start)
    while at < n:
        base = w.start[at]
        stop = max(at + 1, int(np.searchsorted(w.end, base + PIECE, side="right")))
        size = int(w.end[stop - 1] - base)
        pw, inv = (_POW, _INV) if size <= PIECE else (_powers(_P, size + 1), _powers(_P_INV, size + 1))
        sums = np.zeros(size + 1, U64)
        np.cumsum(_BYTE[w.data[base : base + size]] * pw[:size], out=sums[1:])
        s, e = w.start[at:stop] - base, w.end[at:stop] - base
        out[at:stop] = mix64((sums[e] - sums[s]) * inv[s] + (e - s).astype(U64))
        at = stop
    out[out == 0] = U64(1)
    return out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on (order matters).  Entries
    whose window runs past the array end are left out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= U64(0x9E3779B97F4A7C15)
        out ^= out >> U64(29)
        out += hashes[k : k + n]
    return mix64(out)


def inside_one_text(w: Words, size: int) -> np.ndarray:
    """Word positions whose ``size``-word window stays in its text."""
    n = len(w.start) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    last = np.repeat(w.first[1:], w.counts)[:n]
    at = np.arange(n)
    return at[at + size <= last]


def release() -> None:
    """Give memory that this worker freed earlier back to the system: workers
    are used again by other tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
