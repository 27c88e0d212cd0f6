"""Language identification by character language models.

Every language has an interpolated Kneser-Ney model over the letters of
words (lower-cased, with a mark at both ends), to order ``ORDER``.  The
models are stored together: per order one sorted array of n-gram hashes with
a row of log probabilities (one per language, interpolation already
resolved), and one sorted array of context hashes with the weights that
backing off costs.  A text's score for a language is its cross-entropy per
letter; the lowest one wins.

Calibration: the posterior over languages is a softmax of cross-entropies
over an effective length, whose temperature is fitted on a part of the
sample that the counts have not seen; texts whose best cross-entropy lies
beyond what that part shows are rejected.

Training reads about ``per_language`` documents of each language (a
documented bound; chosen by a hash of the id).  Scoring reads every whole
text once, without a shuffle.  A word is scored once per task: the scores of
up to ``KNOWN_WORDS`` words are remembered by their hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.llm import text as tx
from wardstat.llm.ship import ship

ORDER = 5
PER_LANGUAGE = 400
MAX_LANGUAGES = 500
KNOWN_WORDS = 300_000
UNDETERMINED = "und"
EDGE = 1  # the symbol at both ends of a word
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(ORDER + 1)]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word as code points between two EDGE marks, and where
    each word's symbols begin (one entry more than words).  A word without
    letters has none."""
    joined = "\n".join(texts).lower() + "\n"
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    seen, which = np.unique(code, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in seen.tolist()], bool)[which]
    stop = code == 10
    word = np.cumsum(stop) - stop
    keep = letter & ~stop
    n = np.bincount(word[keep], minlength=len(texts))
    size = np.where(n > 0, n + 2, 0)
    first = np.concatenate(([0], np.cumsum(size)))
    out = np.full(first[-1], EDGE, np.int64)
    at = np.flatnonzero(keep)
    rank = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(first[:-1], n) + 1 + rank] = code[at]
    return out, first


def grams(sym: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Positions to predict, the hash of the last m symbols at each (m from 0
    on), and how many symbols there are from the word's start."""
    place = np.arange(len(sym)) - np.repeat(first[:-1], np.diff(first))
    at = np.flatnonzero(place > 0)
    keys = [np.zeros(len(at), np.uint64)]
    total = np.zeros(len(at), np.uint64)
    for m in range(1, order + 1):
        back = np.maximum(at - (m - 1), 0)
        total = total + sym[back].astype(np.uint64) * _POWERS[m - 1]
        keys.append(tx.mix64(total + np.uint64(m)))
    return at, keys, place[at] + 1


@dataclass
class Models:
    languages: list[str]
    keys: list[np.ndarray]  # by order, sorted
    logp: list[np.ndarray]  # rows by n-gram, columns by language
    contexts: list[np.ndarray]  # by order of the predicted n-gram
    backoff: list[np.ndarray]
    floor: np.ndarray  # log probability of a letter never seen
    temperature: float = 1.0
    cut: np.ndarray | None = None  # largest accepted cross-entropy by language

    def score_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of every word in every language, and how many
        symbols were predicted."""
        sym, first = symbols(texts)
        out = np.zeros((len(texts), len(self.languages)))
        at, keys, have = grams(sym, first, ORDER)
        n = np.maximum(np.diff(first) - 1, 0)
        if not len(at):
            return out, n
        # the contexts of a position: the symbols before it
        _, before, _ = grams_before(sym, at)
        value = np.zeros((len(at), len(self.languages)))
        open_ = np.arange(len(at))
        for m in range(ORDER, 0, -1):
            use = open_[have[open_] >= m]
            late = open_[have[open_] < m]
            row, hit = lookup(self.keys[m], keys[m][use])
            found = use[hit]
            value[found] += self.logp[m][row[hit]]
            miss = use[~hit]
            if len(miss):
                row, hit = lookup(self.contexts[m], before[m - 1][miss])
                value[miss[hit]] += self.backoff[m][row[hit]]
            open_ = np.concatenate((miss, late))
        value[open_] += self.floor
        word = np.repeat(np.arange(len(texts)), n)
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(word, value[:, k], minlength=len(texts))
        return out, n

    def choose(self, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the best language's number, its posterior, accepted or not."""
        length = np.maximum(n, 1)[:, None]
        entropy = -total / length
        best = entropy.argmin(1) if entropy.shape[1] else np.zeros(len(n), np.int64)
        z = -(entropy - entropy.min(1, keepdims=True)) * np.minimum(length, 200) * self.temperature
        p = 1 / np.exp(z).sum(1)
        ok = np.ones(len(n), bool) if self.cut is None else entropy[np.arange(len(n)), best] <= self.cut[best]
        return best, p, ok


def grams_before(sym: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], None]:
    """Hashes of the m symbols before each position (m from 0 to ORDER - 1)."""
    keys = [np.zeros(len(at), np.uint64)]
    total = np.zeros(len(at), np.uint64)
    for m in range(1, ORDER):
        total = total + sym[np.maximum(at - m, 0)].astype(np.uint64) * _POWERS[m - 1]
        keys.append(tx.mix64(total + np.uint64(m)))
    return at, keys, None


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    row = np.searchsorted(table, keys)
    row[row == len(table)] = 0
    return row, table[row] == keys


def train(words_of: dict[str, tuple[list[str], np.ndarray]]) -> Models:
    """Models from {language: (distinct words, counts)}."""
    languages = sorted(words_of)
    per: list[list[dict]] = []
    for name in languages:
        texts, count = words_of[name]
        sym, first = symbols(texts)
        at, keys, have = grams(sym, first, ORDER)
        _, before, _ = grams_before(sym, at)
        weight = np.repeat(count.astype(np.float64), np.maximum(np.diff(first) - 1, 0))
        orders: list[dict] = [{}]
        for m in range(1, ORDER + 1):
            full = have >= m
            k, inv = np.unique(keys[m][full], return_inverse=True)
            where = np.flatnonzero(full)
            some = np.zeros(len(k), np.int64)
            some[inv] = where  # a position that shows the n-gram
            c = np.bincount(inv, weight[full], minlength=len(k)) if len(k) else np.zeros(0)
            orders.append({"key": k, "count": c, "some": some, "starts": have[some] == m,
                           "context": before[m - 1][some], "suffix": keys[m - 1][some]})
        # below the highest order, n-grams that can be extended to the left
        # count in how many ways they are
        for m in range(1, ORDER):
            o, up = orders[m], orders[m + 1]
            ways = np.zeros(len(o["key"]))
            row, hit = lookup(o["key"], up["suffix"])
            np.add.at(ways, row[hit], 1)
            o["count"] = np.where(o["starts"], o["count"], np.maximum(ways, 1))
        per.append(orders)
    n_lang = len(languages)
    letters = len(np.unique(np.concatenate([o[1]["key"] for o in per]))) + 1
    model = Models(languages, [np.zeros(0, np.uint64)], [np.zeros((0, n_lang))], [np.zeros(0, np.uint64)], [np.zeros((0, n_lang))], np.full(n_lang, -np.log(letters)))
    lower = None
    for m in range(1, ORDER + 1):
        union, pick = np.unique(np.concatenate([o[m]["key"] for o in per]), return_index=True)
        context = np.concatenate([o[m]["context"] for o in per])[pick]
        suffix = np.concatenate([o[m]["suffix"] for o in per])[pick]
        contexts = np.unique(context)
        p, gamma = np.zeros((len(union), n_lang)), np.ones((len(contexts), n_lang))
        base = np.full((len(union), n_lang), 1 / letters) if m == 1 else np.exp(lower[1][np.searchsorted(lower[0], suffix)])
        ctx_row = np.searchsorted(contexts, context)
        for k, orders in enumerate(per):
            o = orders[m]
            n1, n2 = (o["count"] == 1).sum(), (o["count"] == 2).sum()
            d = min(0.95, max(0.1, n1 / max(1, n1 + 2 * n2)))
            row = np.searchsorted(contexts, o["context"])
            total = np.bincount(row, o["count"], minlength=len(contexts))
            kinds = np.bincount(row, minlength=len(contexts))
            gamma[:, k] = np.where(total > 0, d * kinds / np.maximum(total, 1e-9), 1.0)
            p[np.searchsorted(union, o["key"]), k] = np.maximum(o["count"] - d, 0) / total[row]
        logp = np.log(p + gamma[ctx_row] * base)
        model.keys.append(union)
        model.logp.append(logp.astype(np.float32))
        model.contexts.append(contexts)
        model.backoff.append(np.log(gamma).astype(np.float32))
        lower = (union, logp)
    return model


def calibrate(model: Models, total: np.ndarray, n: np.ndarray, truth: np.ndarray) -> None:
    """Temperature by maximum likelihood, and the acceptance cut, from texts
    that the counts have not seen."""
    use = n > 0
    if not use.any():
        return
    length = n[use][:, None]
    entropy = -total[use] / length
    rows = np.arange(len(entropy))
    loss = []
    grid = np.geomspace(0.02, 5, 40)
    for t in grid:
        z = -entropy * np.minimum(length, 200) * t
        z -= z.max(1, keepdims=True)
        loss.append(-(z[rows, truth[use]] - np.log(np.exp(z).sum(1))).mean())
    model.temperature = float(grid[int(np.argmin(loss))])
    model.cut = np.full(len(model.languages), np.inf)
    for k in range(len(model.languages)):
        own = entropy[truth[use] == k, k]
        if len(own) >= 5:
            model.cut[k] = own.mean() + 8 * own.std() + 0.5


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_language: int = PER_LANGUAGE) -> Models:
    """Train on about ``per_language`` documents of each non-null language;
    a fifth of them calibrates.  Without any such document the result knows
    no language."""
    ship(docs.sparkSession)
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"), text_col)
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Models([], [], [], [], [], np.zeros(0))
    share = F.create_map(*[F.lit(x) for kv in sorted(sizes.items()) for x in (kv[0], per_language / kv[1])])
    u = F.pmod(F.xxhash64(F.lit("lang"), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(u < share[F.col("lang")]).withColumn("check", F.pmod(F.xxhash64(F.lit("check"), "id"), F.lit(5)) == 0)

    def counts(batches):
        for b in tx.chunks(batches, text_col):
            w = tx.words(*tx.utf8(b.column(text_col)))
            data = w.data.tobytes()
            doc = w.text_of_word()
            ids, langs, check = (b.column(c).to_pylist() for c in ("id", "lang", "check"))
            for k in range(b.num_rows):
                words = [data[s:e].decode() for s, e in zip(w.start[doc == k].tolist(), w.end[doc == k].tolist(), strict=True)]
                got = pd.Series(words, dtype=object).value_counts()
                yield pa.RecordBatch.from_pydict({"lang": [langs[k]], "doc": pa.array([ids[k] if check[k] else None], pa.string()),
                                                  "words": pa.array([got.index.tolist()], pa.list_(pa.string())),
                                                  "n": pa.array([got.tolist()], pa.list_(pa.int64()))})

    schema = "lang string, doc string, words array<string>, n array<long>"
    rows = sample.mapInArrow(counts, schema).collect()  # about per_language texts a language
    words_of: dict[str, tuple[list[str], np.ndarray]] = {}
    for lang in sorted(sizes):
        total: dict[str, int] = {}
        for r in rows:
            if r["lang"] == lang and r["doc"] is None:
                for word, n in zip(r["words"], r["n"], strict=True):
                    total[word] = total.get(word, 0) + n
        if any(any(ch.isalpha() for ch in word) for word in total):
            texts = sorted(total)
            words_of[lang] = (texts, np.array([total[x] for x in texts]))
    if not words_of:
        return Models([], [], [], [], [], np.zeros(0))
    model = train(words_of)
    sums, lengths, truth = [], [], []
    for r in sorted((r for r in rows if r["doc"] is not None and r["lang"] in words_of), key=lambda r: (r["lang"], r["doc"])):
        value, n = model.score_words(r["words"])
        count = np.array(r["n"])
        sums.append((value * count[:, None]).sum(0))
        lengths.append((n * count).sum())
        truth.append(model.languages.index(r["lang"]))
    if sums:
        calibrate(model, np.array(sums), np.array(lengths), np.array(truth))
    return model


def predict(docs: DataFrame, model: Models, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Every row with ``lang_best`` (the language of the lowest cross-entropy;
    ``und`` without a letter or for a null text), ``lang_pred`` (the same, but
    ``und`` where rejected) and ``score`` (0 to 1, the calibrated posterior; 0
    for ``und``).  ``keep`` names the columns to pass on (all by default, but
    for the added names)."""
    ship(docs.sparkSession)
    added = ["lang_best", "lang_pred", "score"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("lang_best", T.StringType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        m = shared.value
        known = np.zeros(0, np.uint64)
        values = np.zeros((0, len(m.languages) + 1))
        for b in tx.chunks(batches, text_col):
            w = tx.words(*tx.utf8(b.column(text_col)))
            number, distinct = pd.factorize(tx.word_hashes(w))
            if len(known) > KNOWN_WORDS:
                known, values = known[:0], values[:0]
            _, have = lookup(known, distinct)
            new = np.flatnonzero(~have)
            if len(new):
                where = np.empty(len(distinct), np.int64)
                where[number[::-1]] = np.arange(len(number))[::-1]
                data = w.data.tobytes()
                texts = [data[w.start[i] : w.end[i]].decode() for i in where[new]]
                got, n = m.score_words(texts) if m.languages else (np.zeros((len(texts), 0)), (np.diff(symbols(texts)[1]) > 0).astype(np.int64))
                keys = np.concatenate((known, distinct[new]))
                order = np.argsort(keys)
                known = keys[order]
                values = np.concatenate((values, np.column_stack((got, n))))[order]
            row, _ = lookup(known, distinct)
            sums = np.zeros((b.num_rows, values.shape[1]))
            doc = w.text_of_word()
            at = row[number] if len(number) else np.zeros(0, np.int64)
            for k in range(values.shape[1]):
                sums[:, k] = np.bincount(doc, values[at, k], minlength=b.num_rows)
            n = sums[:, -1]
            if m.languages:
                best, p, ok = m.choose(sums[:, :-1], n)
                name = np.array([*m.languages, UNDETERMINED], object)
                first = name[np.where(n > 0, best, -1)]
                pred = name[np.where((n > 0) & ok, best, -1)]
                p = np.where(n > 0, p, 0.0)
            else:
                first = pred = np.full(b.num_rows, UNDETERMINED, object)
                p = np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array(first.tolist(), pa.string()), pa.array(pred.tolist(), pa.string()), pa.array(p)],
                names=[*names, *added],
            )

    return docs.select(*dict.fromkeys([*names, text_col])).mapInArrow(run, schema)
