r"""Token ids as compressed, checksummed blocks.

File format.  A shard is a run of documents in id order; its ids (each
document's, then the end id) are one sequence, cut into blocks of
``BLOCK_IDS`` ids.  A block is one binary record, little-endian:

    4 bytes  "TKB1"
    8 + 8    shard number, number of the block's first id in its shard
    4 + 4    ids in the block, document pieces in the block
    4        bytes of the alphabet
    4        crc32 of the ids as unsigned 32-bit integers
    4        crc32 of the whole record with these 4 bytes 0
    then per piece: 8 document id, 8 number of the document in its shard,
             4 ids of it here, 1 flags (1: begins here, 2: ends here, 4: null id)
    then the alphabet: the block's distinct ids, ascending, as differences in
             7-bit groups, low first, the top bit set on all but the last
    then the payload: 32-bit words of the range coder

Records are rows of a Parquet table (columns shard, first, record), so they
are committed, listed and found by Spark on any store, and can be split
anywhere.  A block is coded with no memory of any other one, so it is decoded
and verified by itself; a wrong checksum raises.

Coder.  For every id three predictions are mixed into one distribution over
the block's alphabet: order 2 (the id that last followed this pair of ids)
and order 1 (the id that last followed this id) put a mass on one id each, as
large as predictions with the same run of successes have earned in this block
so far; order 0 (adaptive frequencies, refreshed as the block grows) spreads
the rest.  The mixture drives a carry-less range coder with 64-bit low and
range.  All blocks of a group advance by one id at a time as lanes of numpy
arrays: everything is integer arithmetic, so decoding repeats it exactly.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardstat.llm import text as tx
from wardstat.llm.components import written
from wardstat.llm.ship import ship

BLOCK_IDS = 8192
LANES = 512
END_ID = 2
MAGIC = b"TKB1"
HEAD = struct.Struct("<4sqqIIIII")
PIECE = np.dtype([("id", "<i8"), ("row", "<i8"), ("n", "<u4"), ("flags", "u1")])
BEGINS, ENDS, NULL_ID = 1, 2, 4
KNOWN_WORDS = 400_000  # words a task remembers the ids of; it starts anew beyond

U64 = np.uint64
BITS = 26  # probabilities are in units of 2^-26
SCALE = 20  # order-0 frequencies sum to 2^20 at most
LEVELS = 8  # runs of successes told apart
ORDER2_BITS = 12
GAIN = 32  # weight of a seen id against an unseen one of the alphabet
REFRESH = 256
_LOW32, _ALL = U64(0xFFFFFFFF), U64(0xFFFFFFFFFFFFFFFF)


class Model:
    """Predictions for the blocks of a group, lane by lane.

    ``sizes`` are the alphabets' sizes; ids are numbers within an alphabet.
    """

    def __init__(self, sizes: np.ndarray):
        lanes, width = len(sizes), int(sizes.max(initial=1))
        self.width = width
        self.lane = np.arange(lanes)
        # a lane's cumulative frequencies have a power of two of places, for
        # binary search; places beyond the alphabet are never reached
        self.jumps = [1 << k for k in range((width + 1).bit_length() - 1, -1, -1)]
        self.places = 2 * self.jumps[0]
        self.row1, self.row2, self.row0 = self.lane * width, self.lane << ORDER2_BITS, self.lane * self.places
        self.rowk = self.lane * LEVELS
        # the id seen last in a context and its run of successes: id * LEVELS + run
        self.table1 = np.zeros(lanes * width, np.int32)
        self.table2 = np.zeros(lanes << ORDER2_BITS, np.int32)
        start = np.array([1024, 16384, 32768, 40960, 49152, 53248, 57344, 60000])
        self.odds1, self.odds2 = np.tile(start, lanes), np.tile(start, lanes)
        self.sizes = sizes
        self.count = np.zeros((lanes, width), np.int32)
        self.flat_count = self.count.reshape(-1)
        self.cum = np.full((lanes, self.places), 1 << 30, np.int32)
        self.flat = self.cum.reshape(-1)
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)
        self.at, self.refresh_at = 0, 16
        self.refresh()

    def refresh(self) -> None:
        """Order 0 as cumulative frequencies, at least 1 each, that sum to
        less than 2^SCALE."""
        room = (1 << SCALE) - BLOCK_IDS - 1  # the same whatever blocks are beside
        column = np.arange(1, self.width + 1)
        for k in range(0, len(self.lane), 64):  # a few lanes at a time stay in cache
            own = np.minimum(column, self.sizes[k : k + 64, None])
            cum = np.cumsum(self.count[k : k + 64], axis=1, dtype=np.int64) * GAIN + own
            cum *= room
            cum //= cum[:, -1:] // room + (cum[:, -1:] == 0)
            self.cum[k : k + 64, 1 : self.width + 1] = cum + own
            self.cum[k : k + 64, 0] = 0
        self.top = self.cum[self.lane, self.sizes].astype(np.int64)

    def predict(self) -> None:
        """Candidates and their masses in units of 2^-BITS; order 0 has the rest."""
        self.slot1 = self.row1 + self.last
        self.slot2 = self.row2 + ((self.before * 40503 + self.last * 30011) & ((1 << ORDER2_BITS) - 1))
        e1, e2 = self.table1[self.slot1].astype(np.int64), self.table2[self.slot2].astype(np.int64)
        self.c1, self.c2, self.r1, self.r2 = e1 >> 3, e2 >> 3, e1 & 7, e2 & 7
        self.k1, self.k2 = self.rowk + self.r1, self.rowk + self.r2
        self.p1, self.p2 = self.odds1[self.k1], self.odds2[self.k2]
        one = (1 << 10) - (1 << 4)  # order 0 keeps a 64th at least
        self.m2 = self.p2 * one
        self.m1 = ((one << 16) - self.m2) * self.p1 >> 16
        self.m1 *= self.c1 != self.c2
        self.m0 = (1 << BITS) - self.m2 - self.m1

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids' masses begin, and the masses."""
        at = self.row0 + ids
        low, high = self.flat[at] * self.m0 >> SCALE, self.flat[at + 1] * self.m0 >> SCALE
        self.hit1, self.hit2 = self.c1 == ids, self.c2 == ids
        start = low + self.m1 * (self.c1 < ids) + self.m2 * (self.c2 < ids)
        return start, high - low + self.m1 * self.hit1 + self.m2 * self.hit2

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids whose masses hold ``value``."""
        swap = self.c1 > self.c2
        a, b = np.where(swap, self.c2, self.c1), np.where(swap, self.c1, self.c2)
        ma, mb = np.where(swap, self.m2, self.m1), np.where(swap, self.m1, self.m2)
        cum, m0 = self.flat, self.m0
        at_a, at_b = self.row0 + a, self.row0 + b
        low_a, high_a = cum[at_a] * m0 >> SCALE, (cum[at_a + 1] * m0 >> SCALE) + ma
        low_b, high_b = (cum[at_b] * m0 >> SCALE) + ma, (cum[at_b + 1] * m0 >> SCALE) + ma + mb
        in_a = (value >= low_a) & (value < high_a)
        in_b = (value >= low_b) & (value < high_b)
        out = np.where(in_a, a, b)
        rest = np.flatnonzero(~(in_a | in_b))
        if len(rest):
            v = value[rest]
            v = v - ma[rest] * (v >= high_a[rest]) - mb[rest] * (v >= high_b[rest])
            s = np.minimum((((v + 1) << SCALE) - 1) // m0[rest], self.top[rest] - 1)
            # the last place whose sum is at most s
            at = self.row0[rest]
            for jump in self.jumps:
                at = at + jump * (cum[at + jump] <= s)
            out[rest] = at - self.row0[rest]
        return out

    def learn(self, ids: np.ndarray) -> None:
        """After ``interval(ids)``."""
        h1, h2 = self.hit1, self.hit2
        self.odds1[self.k1] = self.p1 + (h1 * 65024 + 256 - self.p1 >> 4)
        self.odds2[self.k2] = self.p2 + (h2 * 65024 + 256 - self.p2 >> 4)
        keep1, keep2 = h1 | (self.r1 > 1), h2 | (self.r2 > 1)
        run1 = np.where(h1, np.minimum(self.r1 + 1, LEVELS - 1), self.r1 >> 1)
        run2 = np.where(h2, np.minimum(self.r2 + 1, LEVELS - 1), self.r2 >> 1)
        self.table1[self.slot1] = (np.where(keep1, self.c1, ids) << 3) + run1
        self.table2[self.slot2] = (np.where(keep2, self.c2, ids) << 3) + run2
        self.flat_count[self.row1 + ids] += 1
        self.before, self.last = self.last, ids
        self.at += 1
        if self.at == self.refresh_at:
            self.refresh_at = min(2 * self.at, self.at + REFRESH)
            self.refresh()


def _carry(low: np.ndarray, span: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Shift 32 bits out of the lanes ``small``, whose span is below 2^32; a
    range across a 32-bit border is cut there.  Returns the bits."""
    lo, sp = low[small], span[small]
    across = (lo >> U64(32)) != ((lo + sp - U64(1)) >> U64(32))
    sp[across] = U64(0x100000000) - (lo[across] & _LOW32)
    low[small] = lo << U64(32)
    # 2^32 * 2^32 does not fit; one less does no harm
    span[small] = np.where(sp > _LOW32, _ALL, sp << U64(32))
    return lo >> U64(32)


def encode_lanes(ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """One payload per row of ``ids``; row k has ``lengths[k]`` ids below
    ``sizes[k]``.  Rows are in order of falling length."""
    lanes, steps = ids.shape
    model = Model(sizes)
    low, span = np.zeros(lanes, U64), np.full(lanes, _ALL, U64)
    words = np.zeros((lanes, steps + 4), np.uint32)
    n_out = np.zeros(lanes, np.int64)
    by_step, shift = np.ascontiguousarray(ids.T), U64(BITS)
    all_live = lengths.min() if lanes else 0
    for t in range(steps):
        model.predict()
        now = by_step[t].astype(np.int64)
        start, mass = model.interval(now)
        unit = span >> shift
        if t < all_live:
            low += unit * start.view(U64)
            span = unit * mass.view(U64)
        else:
            live = t < lengths
            low = np.where(live, low + unit * start.view(U64), low)
            span = np.where(live, unit * mass.view(U64), span)
        small = np.flatnonzero(span <= _LOW32)
        if len(small):
            words[small, n_out[small]] = _carry(low, span, small).astype(np.uint32)
            n_out[small] += 1
        model.learn(now)
    for part in (low >> U64(32), low & _LOW32):
        words[np.arange(lanes), n_out] = part.astype(np.uint32)
        n_out += 1
    return [words[k, : n_out[k]].astype("<u4").tobytes() for k in range(lanes)]


def decode_lanes(payloads: list[bytes], lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    lanes, steps = len(payloads), int(lengths.max(initial=0))
    n_words = np.array([len(p) // 4 for p in payloads])
    words = np.zeros((lanes, n_words.max(initial=0) + 4), np.uint64)
    for k, p in enumerate(payloads):
        words[k, : n_words[k]] = np.frombuffer(p, "<u4")
    model = Model(sizes)
    out = np.zeros((steps, lanes), np.int32)
    low, span = np.zeros(lanes, U64), np.full(lanes, _ALL, U64)
    code = (words[:, 0] << U64(32)) | words[:, 1]
    n_in = np.full(lanes, 2, np.int64)
    shift, top, last = U64(BITS), U64((1 << BITS) - 1), words.shape[1] - 1
    all_live = lengths.min() if lanes else 0
    for t in range(steps):
        model.predict()
        unit = span >> shift
        sym = model.find(np.minimum((code - low) // unit, top).view(np.int64))
        if t >= all_live:
            live = t < lengths
            sym[~live] = 0
        start, mass = model.interval(sym)
        if t < all_live:
            low += unit * start.view(U64)
            span = unit * mass.view(U64)
        else:
            low = np.where(live, low + unit * start.view(U64), low)
            span = np.where(live, unit * mass.view(U64), span)
        small = np.flatnonzero(span <= _LOW32)
        if len(small):
            _carry(low, span, small)
            code[small] = (code[small] << U64(32)) | words[small, np.minimum(n_in[small], last)]
            n_in[small] += 1
        out[t] = sym
        model.learn(sym)
    return out.T


_PUNCTUATION = np.zeros(256, bool)  # ASCII punctuation but the apostrophe, which begins contractions
_PUNCTUATION[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def split_at_punctuation(w: tx.Words, offsets: np.ndarray) -> tx.Words:
    """The words cut where ASCII punctuation follows a letter of Latin, so
    that "word" and "word," share what has to be encoded."""
    d = w.data
    if len(d) < 3:
        return w
    letter = _LETTER[d]
    # two-byte letters U+00C0 to U+024F, without the signs U+00D7 and U+00F7
    # and without U+0130, whose lower case ends in a mark
    two = (d[:-1] >= 0xC3) & (d[:-1] <= 0xC9) & (d[1:] >= 0x80)
    two &= ~((d[:-1] == 0xC3) & ((d[1:] == 0x97) | (d[1:] == 0xB7)))
    two &= ~((d[:-1] == 0xC4) & (d[1:] == 0xB0))
    letter[1:] |= two
    cut = np.flatnonzero(letter[:-1] & _PUNCTUATION[d[1:]]) + 1
    cut = cut[~np.isin(cut, offsets)]
    start, end = np.sort(np.concatenate((w.start, cut))), np.sort(np.concatenate((w.end, cut)))
    return tx.Words(d, start, end, np.searchsorted(start, offsets).astype(np.int64))


class WordIds:
    """Ids of words, remembered by the words' hashes.

    Splitting at ASCII white space and before punctuation changes no id: the
    tokenizer must drop white space and keep letters and punctuation apart,
    which ``splits_at_space`` tests.  Texts that hold a special token's
    string are cut at white space alone.
    """

    def __init__(self, file: bytes):
        self.tokenizer = Tokenizer.from_buffer(file)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        comma = self.tokenizer.encode(",", add_special_tokens=False).ids
        self.comma = comma[0] if len(comma) == 1 else -1
        self.clear()

    def cut(self, column: pa.Array) -> tx.Words:
        data, offsets = tx.utf8(column)
        w = tx.words(data, offsets)
        raw = data.tobytes()
        return w if any(t in raw for t in self.special) else split_at_punctuation(w, offsets)

    def clear(self) -> None:
        self.known = np.zeros(0, U64)  # sorted; slot k begins at first[k] of ids
        self.slot = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def fresh(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts, joined; how many each has; and each text's place
        among them.  Many texts are encoded in one call, with commas between."""
        comma = [self.comma < 0 or "," in t for t in texts]
        plain = [i for i, c in enumerate(comma) if not c]
        alone = [i for i, c in enumerate(comma) if c]
        flat, sizes, done = [], [], []
        for k in range(0, len(plain), 20_000):
            groups = [plain[g : g + 1000] for g in range(k, min(k + 20_000, len(plain)), 1000)]
            for g, e in zip(groups, self.encode([" , ".join([texts[i] for i in g]) for g in groups], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.int64)
                between = ids == self.comma
                at = np.flatnonzero(between)
                if len(at) != len(g) - 1:  # another text has that id too
                    alone += g
                    continue
                flat.append(ids[~between])
                sizes.append(np.diff(np.concatenate(([-1], at, [len(ids)]))) - 1)
                done += g
        for k in range(0, len(alone), 5000):
            part = alone[k : k + 5000]
            got = [np.array(e.ids, np.int64) for e in self.encode([texts[i] for i in part], add_special_tokens=False)]
            flat += got
            sizes.append(np.array([len(g) for g in got], np.int64))
            done += part
        place = np.empty(len(texts), np.int64)
        place[np.array(done, np.int64)] = np.arange(len(texts))
        return np.concatenate(flat), np.concatenate(sizes), place

    def __call__(self, w: tx.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, in order, and how many each word has."""
        if not len(hashes):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        number, distinct = pd.factorize(hashes)
        if len(self.known) > KNOWN_WORDS:
            self.clear()
        at = np.searchsorted(self.known, distinct)
        have = np.zeros(len(distinct), bool)
        inside = at < len(self.known)
        have[inside] = self.known[at[inside]] == distinct[inside]
        new = np.flatnonzero(~have)
        if len(new):
            # where each new word stands first
            where = np.empty(len(distinct), np.int64)
            where[number[::-1]] = np.arange(len(number))[::-1]
            data = w.data.tobytes()
            texts = [data[s:e].decode() for s, e in zip(w.start[where[new]].tolist(), w.end[where[new]].tolist(), strict=True)]
            flat, sizes, place = self.fresh(texts)
            order = np.argsort(distinct[new])
            slots = len(self.first) - 1 + place[order]
            self.ids = np.concatenate((self.ids, flat.astype(np.int32)))
            self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes)))
            keys = distinct[new][order]
            spot = np.searchsorted(self.known, keys)
            self.known, self.slot = np.insert(self.known, spot, keys), np.insert(self.slot, spot, slots)
            at = np.searchsorted(self.known, distinct)
        slot = self.slot[at][number]
        n = self.first[slot + 1] - self.first[slot]
        return self.ids[_ramps(self.first[slot], n)], n


def _ramps(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] of them), start[1], ..."""
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(total)


def splits_at_space(file: bytes) -> bool:
    """Whether the tokenizer drops white space and keeps letters and
    punctuation apart, so that words can be encoded one by one."""
    t = Tokenizer.from_buffer(file)
    probe = "Ab 1c, 'll\tx\n\n d-e  é́ \x0b\x0cF. 's 2 　 g"
    whole = t.encode(probe, add_special_tokens=False).ids
    if t.encode("ab,cd\u00e9.", add_special_tokens=False).ids != [i for p in ("ab", ",", "cd\u00e9", ".") for i in t.encode(p, add_special_tokens=False).ids]:
        return False
    parts = [i for p in probe.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if p
             for i in t.encode(p, add_special_tokens=False).ids]
    return whole == parts


def _alphabet_bytes(distinct: np.ndarray) -> bytes:
    out = bytearray()
    for d in np.diff(distinct, prepend=0).tolist():
        while d > 127:
            out.append(d & 127 | 128)
            d >>= 7
        out.append(d)
    return bytes(out)


def _alphabet(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).astype(np.int64)
    ends = np.flatnonzero(b < 128)
    begin = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(b)) - np.repeat(begin, ends - begin + 1)
    return np.cumsum(np.add.reduceat((b & 127) << (7 * place), begin)) if len(ends) else np.zeros(0, np.int64)


def _group_records(shard: int, first: int, ids: np.ndarray, pieces: list[np.ndarray]) -> list[bytes]:
    """Records of consecutive blocks, coded side by side; ``first`` is the
    number of the first id in the shard, ``pieces`` the blocks' pieces."""
    n_blocks = len(pieces)
    lengths = np.full(n_blocks, BLOCK_IDS)
    lengths[-1] = len(ids) - BLOCK_IDS * (n_blocks - 1)
    local = np.zeros((n_blocks, int(lengths.max())), np.int32)
    alphabets = []
    rank = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    for k in range(n_blocks):
        block = ids[k * BLOCK_IDS : k * BLOCK_IDS + lengths[k]]
        rank[block] = 1
        distinct = np.flatnonzero(rank)
        rank[distinct] = np.arange(len(distinct))
        local[k, : lengths[k]] = rank[block]
        rank[distinct] = 0
        alphabets.append(distinct)
    payloads = encode_lanes(local, lengths, np.array([len(a) for a in alphabets]))
    out = []
    for k in range(n_blocks):
        alphabet = _alphabet_bytes(alphabets[k])
        block = ids[k * BLOCK_IDS : k * BLOCK_IDS + lengths[k]].astype("<u4").tobytes()
        fields = (MAGIC, shard, first + k * BLOCK_IDS, int(lengths[k]), len(pieces[k]), len(alphabet), zlib.crc32(block))
        body = pieces[k].tobytes() + alphabet + payloads[k]
        check = zlib.crc32(HEAD.pack(*fields, 0) + body)
        out.append(HEAD.pack(*fields, check) + body)
    return out


def read_records(records: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(shard, first, pieces, ids) of every record, verified."""
    parsed = []
    for raw in records:
        magic, shard, first, n, n_pieces, n_alphabet, crc, check = HEAD.unpack_from(raw)
        if magic != MAGIC or zlib.crc32(HEAD.pack(magic, shard, first, n, n_pieces, n_alphabet, crc, 0) + raw[HEAD.size :]) != check:
            raise ValueError("a token block is damaged")
        a = HEAD.size + n_pieces * PIECE.itemsize
        pieces = np.frombuffer(raw, PIECE, n_pieces, HEAD.size)
        parsed.append((shard, first, n, crc, pieces, _alphabet(raw[a : a + n_alphabet]), raw[a + n_alphabet :]))
    lengths = np.array([p[2] for p in parsed])
    local = decode_lanes([p[6] for p in parsed], lengths, np.array([len(p[5]) for p in parsed]))
    for k, (shard, first, n, crc, pieces, alphabet, _) in enumerate(parsed):
        ids = alphabet[local[k, :n]].astype("<u4")
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {first} of shard {shard} decodes to other ids")
        yield shard, first, pieces, ids


def write_blocks(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every text and write the blocks as a Parquet table at ``path``.

    Rows are range-partitioned and sorted by id (null ids first, equal ids by
    a hash of the text), so shards follow each other in id order.  Null and
    empty texts have the end id alone.  Extra columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, "rb") as f:
        file = f.read()
    vocabulary = spark.sparkContext.broadcast(file)  # the tokenizer's file, whatever the input
    if not splits_at_space(file):
        raise ValueError("the tokenizer keeps white space; words can't be encoded one by one")
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(text_col), F.col(text_col)]
    ordered = docs.select(F.col(id_col).cast("long").alias(id_col), text_col).repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        tx.release()
        word_ids = WordIds(vocabulary.value)
        shard, first, row = TaskContext.get().partitionId(), 0, 0
        ids, sizes, keys = [], [], []  # of documents not yet written
        held, open_piece = 0, 0  # ids held; ids of the first held document that are written already

        def blocks(everything: bool):
            nonlocal ids, sizes, keys, held, open_piece, first, row
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            key = np.concatenate(keys) if keys else np.zeros(0, PIECE)
            n_blocks = -(-len(flat) // BLOCK_IDS) if everything else len(flat) // BLOCK_IDS
            if not n_blocks:
                return None
            done = min(len(flat), n_blocks * BLOCK_IDS)
            stop = np.cumsum(size)
            start = stop - size
            pieces = []
            for b in range(n_blocks):
                lo, hi = b * BLOCK_IDS, min(done, (b + 1) * BLOCK_IDS)
                i, j = np.searchsorted(stop, lo, side="right"), np.searchsorted(start, hi, side="left")
                p = key[i:j].copy()
                p["row"] = row + np.arange(i, j)
                p["n"] = np.minimum(stop[i:j], hi) - np.maximum(start[i:j], lo)
                began = start[i:j] >= lo
                if i == 0 and b == 0 and open_piece:
                    began[0] = False
                p["flags"] |= (began * BEGINS + (stop[i:j] <= hi) * ENDS).astype(np.uint8)
                pieces.append(p)
            records, at = [], first
            for b in range(0, n_blocks, LANES):
                records += _group_records(shard, at, flat[b * BLOCK_IDS : min(done, (b + LANES) * BLOCK_IDS)], pieces[b : b + LANES])
                at += LANES * BLOCK_IDS
            firsts = [first + BLOCK_IDS * b for b in range(n_blocks)]
            first += done
            gone = int(np.searchsorted(stop, done, side="right"))
            row += gone
            ids, held = [flat[done:].copy()], len(flat) - done
            open_piece = int(done - start[gone]) if gone < len(size) else 0
            rest = size[gone:].copy()
            if len(rest):
                rest[0] -= open_piece
            sizes, keys = [rest], [key[gone:]]
            return pa.RecordBatch.from_arrays(
                [pa.array([shard] * n_blocks, pa.int64()), pa.array(firsts, pa.int64()), pa.array(records, pa.binary())],
                names=["shard", "first", "record"],
            )

        for b in tx.chunks(batches, text_col):
            w = word_ids.cut(b.column(text_col))
            got, n = word_ids(w, tx.word_hashes(w))
            edge = np.concatenate(([0], np.cumsum(n)))[w.first]
            flat = np.insert(got, edge[1:], end_id)
            key = np.zeros(b.num_rows, PIECE)
            column = b.column(id_col)
            key["id"] = column.fill_null(0).to_numpy(zero_copy_only=False)
            key["flags"] = column.is_null().to_numpy(zero_copy_only=False) * NULL_ID
            ids.append(flat)
            sizes.append(np.diff(edge) + 1)
            keys.append(key)
            held += len(flat)
            if held >= LANES * BLOCK_IDS:
                out = blocks(False)
                if out is not None:
                    yield out
        out = blocks(True)
        if out is not None:
            yield out
        tx.release()

    ordered.mapInArrow(run, "shard long, first long, record binary").write.parquet(path)


def _pieces(blocks: DataFrame) -> DataFrame:
    """(shard, row, id, first, n, crc) of every document's part of every block."""

    def run(batches):
        tx.release()
        for batch in batches:
            for at in range(0, batch.num_rows, LANES):
                raw = batch.column(0).slice(at, LANES).to_pylist()
                cols: list[list[np.ndarray]] = [[], [], [], [], [], [], []]
                for shard, first, pieces, ids in read_records(raw):
                    stop = np.cumsum(pieces["n"].astype(np.int64))
                    start = stop - pieces["n"]
                    crc = np.array([zlib.crc32(ids[a:z].tobytes()) for a, z in zip(start, stop, strict=True)], np.int64)
                    null = (pieces["flags"] & NULL_ID) > 0
                    for c, v in zip(cols, (np.full(len(pieces), shard), pieces["row"], pieces["id"], null, first + start, pieces["n"].astype(np.int64), crc), strict=True):
                        c.append(v)
                shard, row, ident, null, first, n, crc = (np.concatenate(c) for c in cols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(row), pa.array(ident, mask=null), pa.array(first), pa.array(n), pa.array(crc)],
                    names=["shard", "row", "id", "first", "n", "crc"],
                )

    return blocks.select("record").mapInArrow(run, "shard long, row long, id long, first long, n long, crc long")


def joined_crc(crcs: list[int], counts: list[int]) -> int:
    """crc32 of the joined ids from the parts' crcs and numbers of ids."""
    out = crcs[0]
    for crc, n in zip(crcs[1:], counts[1:], strict=True):
        zeros = bytes(4 * n)
        out = zlib.crc32(zeros, out) ^ zlib.crc32(zeros) ^ crc
    return out


def read_documents(blocks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, from the blocks alone."""
    ship(blocks.sparkSession)
    pieces = written(_pieces(blocks), "token-pieces")
    up = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy("shard").agg(F.sum("n").alias("n"))  # a row per shard
    base = totals.select("shard", F.coalesce(F.sum("n").over(up), F.lit(0)).alias("base"))
    whole = pieces.groupBy("shard", "row", "id").agg(
        F.min("first").alias("first"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("first", "n", "crc"))).alias("parts")
    )

    def run(batches):
        for b in batches:
            parts = b.column("parts").to_pylist()
            crc = [p[0]["crc"] if len(p) == 1 else joined_crc([x["crc"] for x in p], [x["n"] for x in p]) for p in parts]
            yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("id"), b.column("first"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                                             names=["shard", "id", "first", "n_tokens", "ids_crc32"])

    one = whole.mapInArrow(run, "shard long, id long, first long, n_tokens long, ids_crc32 long")
    return one.join(base, "shard").select(F.col("id").alias(id_col), (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
