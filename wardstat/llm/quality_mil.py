"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE_WORDS`` consecutive words, over
the whole text).  Every passage becomes a feature vector; a small encoder
turns it into a hidden vector h; gated attention gives it the weight
softmax(w . (tanh(V h) * sigmoid(U h))) within its document; the weighted
mean of the hidden vectors is scored by a logistic unit.  Only the document
label is known in training: the attention weights are learned from it.

Training rows are a bounded, documented sample (``per_label`` documents per
label, the same ones on every run, of at most ``max_passages`` passages each);
every passage of a training text is learned from.  Scoring runs in one pass
over the texts without a shuffle.  The features of a text are made in one
piece, so a very long text needs memory in proportion to its length.

Null and empty texts are bags of one all-zero passage and get a score like
any other; extra columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.llm import text as tx
from wardstat.llm.ship import ship

PASSAGE_WORDS = 48
HIDDEN, GATE = 24, 12

# byte classes counted per passage
_CLASS = np.zeros(256, np.int64)  # 0: other punctuation
_CLASS[0x61:0x7B] = 1
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 3
_CLASS[0x80:] = 4
for _k, _chars in enumerate((".,;:'\"-()", "!?", "|/\\<>{}[]=_~^`", "#$%&*@+"), start=5):
    for _c in _chars.encode():
        _CLASS[_c] = _k
N_CLASSES = 9
N_HASHED = 32
N_FEATURES = N_CLASSES + 7 + N_HASHED


@dataclass
class Bags:
    """Passage features and, per document, where its passages begin."""

    x: np.ndarray
    first: np.ndarray


def passage_features(column: pa.Array) -> Bags:
    """Passages of every text, in order, with a feature vector each."""
    data, offsets = tx.utf8(column)
    w = tx.words(data, offsets)
    n_docs = len(offsets) - 1
    per_doc = np.maximum(1, -(-w.counts // PASSAGE_WORDS))
    first = np.concatenate(([0], np.cumsum(per_doc)))
    x = np.zeros((first[-1], N_FEATURES), np.float32)
    if not len(w.start):
        return Bags(x, first)
    doc = w.text_of_word()
    word_no = np.arange(len(w.start)) - w.first[doc]
    passage = first[doc] + word_no // PASSAGE_WORDS
    begin = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    row = passage[begin]
    n_words = np.diff(np.concatenate((begin, [len(passage)])))
    lo, hi = w.start[begin], w.end[begin + n_words - 1]
    size = (hi - lo).astype(np.float32)
    classes = _CLASS[w.data]
    for c in range(N_CLASSES):
        sums = np.concatenate(([0], np.cumsum(classes == c, dtype=np.int32)))
        x[row, c] = (sums[hi] - sums[lo]) / size
    h = tx.word_hashes(w)
    length = (w.end - w.start).astype(np.float32)
    same = np.zeros(len(h), np.float32)
    same[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    two = np.zeros(len(h), np.float32)
    two[2:] = (h[2:] == h[:-2]) & (passage[2:] == passage[:-2])
    last = w.data[w.end - 1]
    punct_end = np.isin(_CLASS[last], (6, 7, 8)).astype(np.float32)
    head = w.data[w.start]
    upper = ((head >= 0x41) & (head <= 0x5A)).astype(np.float32)
    at = N_CLASSES
    for values in (length / 8, same, two, punct_end, upper):
        x[row, at] = np.add.reduceat(values, begin) / n_words
        at += 1
    # distinct words of the passage, by a bitmap of hashes
    bits = np.bitwise_or.reduceat(np.left_shift(tx.U64(1), h & tx.U64(63)), begin)
    full = 64 * (1 - (1 - 1 / 64) ** n_words)
    x[row, at] = np.bitwise_count(bits) / full
    x[row, at + 1] = np.log1p(n_words) / 4
    at += 2
    # hashed words: presence rates of frequent function words and odd tokens
    slot = passage * N_HASHED + (h >> tx.U64(40)).astype(np.int64) % N_HASHED
    counts = np.bincount(slot, minlength=first[-1] * N_HASHED).reshape(-1, N_HASHED)
    x[:, at:] = counts / np.maximum(1, counts.sum(1, keepdims=True)) * 4
    return Bags(x, first)


@dataclass
class MilModel:
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]
    bias_shift: float = 0.0
    constant: float | None = None  # the score of everything, for want of one of the labels

    def passages(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden vector and attention logit of every passage."""
        p = self.params
        h = np.tanh(((x - self.mean) / self.scale) @ p["E"] + p["e"])
        gate = np.tanh(h @ p["V"] + p["v"]) / (1 + np.exp(-(h @ p["U"] + p["u"])))
        return h, gate @ p["w"]

    def score(self, bags: Bags) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags.first) - 1, self.constant)
        h, logit = self.passages(bags.x)
        weight = np.exp(np.clip(logit, -30, 30)).astype(np.float64)
        starts = bags.first[:-1]
        z = np.add.reduceat(h * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
        out = z @ self.params["o"] + self.params["b"][0] + self.bias_shift
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def train(bags: Bags, label: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01, seed: int = 7) -> MilModel:
    """Fit by Adam on document labels; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    x = bags.x.astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 0.05
    x = (x - mean) / scale
    p = {
        "E": rng.normal(0, 0.15, (N_FEATURES, HIDDEN)), "e": np.zeros(HIDDEN),
        "V": rng.normal(0, 0.2, (HIDDEN, GATE)), "v": np.zeros(GATE),
        "U": rng.normal(0, 0.2, (HIDDEN, GATE)), "u": np.zeros(GATE),
        "w": rng.normal(0, 0.2, GATE), "o": rng.normal(0, 0.2, HIDDEN), "b": np.zeros(1),
    }
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    step, n = 0, len(label)
    for epoch in range(epochs):
        order = rng.permutation(n)
        lr = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for at in range(0, n, batch):
            docs = order[at : at + batch]
            sizes = bags.first[docs + 1] - bags.first[docs]
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            rows = np.repeat(bags.first[docs] - starts, sizes) + np.arange(sizes.sum())
            owner = np.repeat(np.arange(len(docs)), sizes)
            xb = x[rows]
            h = np.tanh(xb @ p["E"] + p["e"])
            t, s = np.tanh(h @ p["V"] + p["v"]), 1 / (1 + np.exp(-(h @ p["U"] + p["u"])))
            logit = (t * s) @ p["w"]
            a = np.exp(logit - np.maximum.reduceat(logit, starts)[owner])
            a /= np.add.reduceat(a, starts)[owner]
            z = np.add.reduceat(h * a[:, None], starts)
            y = 1 / (1 + np.exp(-np.clip(z @ p["o"] + p["b"][0], -40, 40)))
            d_out = (y - label[docs]) * weight[docs] / len(docs)
            g = {"o": z.T @ d_out, "b": np.array([d_out.sum()])}
            dz = np.outer(d_out, p["o"])
            da = (dz[owner] * h).sum(1)
            d_logit = a * (da - np.add.reduceat(a * da, starts)[owner])
            g["w"] = (t * s).T @ d_logit
            dt, ds = np.outer(d_logit, p["w"]) * s * (1 - t * t), np.outer(d_logit, p["w"]) * t * s * (1 - s)
            g["V"], g["v"], g["U"], g["u"] = h.T @ dt, dt.sum(0), h.T @ ds, ds.sum(0)
            dh = (dz[owner] * a[:, None] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
            g["E"], g["e"] = xb.T @ dh, dh.sum(0)
            step += 1
            for k in p:
                grad = g[k] + 1e-4 * p[k]
                m1[k] = 0.9 * m1[k] + 0.1 * grad
                m2[k] = 0.999 * m2[k] + 0.001 * grad * grad
                p[k] = p[k] - lr * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return MilModel(mean.astype(np.float32), scale.astype(np.float32), {k: v.astype(np.float32) for k, v in p.items()})


def threshold_shift(model: MilModel, bags: Bags, label: np.ndarray, cut: float = 0.7) -> float:
    """The logit shift that places ``cut`` where the fewest rows of the
    sample are on the wrong side, each class weighing the same; in the
    middle of the best gap."""
    raw = model.score(bags).clip(1e-9, 1 - 1e-9)
    logit = np.log(raw / (1 - raw))
    order = np.argsort(logit, kind="stable")
    l, y = logit[order], label[order]
    bad_below = np.concatenate(([0], np.cumsum(y == 1))) / max(1, (y == 1).sum())
    bad_above = ((y == 0).sum() - np.concatenate(([0], np.cumsum(y == 0)))) / max(1, (y == 0).sum())
    cost = bad_below + bad_above
    edges = np.concatenate(([l[0] - 1], (l[1:] + l[:-1]) / 2, [l[-1] + 1]))
    gap = np.concatenate(([1.0], l[1:] - l[:-1], [1.0]))
    best = max(np.flatnonzero(cost <= cost.min() + 1e-12), key=lambda k: gap[k])
    return float(np.log(cut / (1 - cut)) - edges[best])


def training_rows(labels: DataFrame, per_label: int, label_col: str, id_col: str) -> DataFrame:
    """``per_label`` labelled ids of each label in a fixed pseudo-random
    order.  Ids labelled more than once with different labels are left out."""
    one = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(id_col)
        .agg(F.min(label_col).alias("_lo"), F.max(label_col).alias("label"))
        .filter("_lo = label")
        .drop("_lo")
    )
    # a distributed top-k per label, not a window that gathers a label's rows
    first = lambda v: one.filter(F.col("label") == v).orderBy(F.xxhash64(id_col), id_col).limit(per_label)
    return first(0).unionByName(first(1))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1500, label_col: str = "quality",
        id_col: str = "doc_id", text_col: str = "text", max_passages: int = 2000) -> MilModel:
    """Train on at most ``per_label`` documents of each label, all passages of
    each.  A document of more than ``max_passages`` passages (96,000 words) is
    not one of the sample, so the driver gets 2 * per_label * max_passages
    feature vectors at most.

    ``labels`` holds (id, 0/1 label) rows that may be learned from; rows with
    null id or another label value are ignored.  Without any document of label
    0 everything scores 1 (there is nothing to reject by), with label 0 alone
    everything scores 0.
    """
    ship(docs.sparkSession)
    picked = training_rows(labels.select(id_col, F.col(label_col).cast("int").alias(label_col)), per_label, label_col, id_col)
    # at most 2 * per_label ids: a proven bound for the broadcast
    sample = docs.select(id_col, text_col).join(F.broadcast(picked), id_col)

    def features(batches):
        for b in tx.chunks(batches, text_col):
            bags = passage_features(b.column(text_col))
            fits = np.diff(bags.first) <= max_passages
            vec = [bags.x[f:e].astype(np.float32).tobytes() if ok else None for f, e, ok in zip(bags.first, bags.first[1:], fits)]
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(pa.string()), b.column("label").cast(pa.int32()), pa.array(vec, pa.binary())],
                names=["id", "label", "x"],
            )

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("label", T.IntegerType()), T.StructField("x", T.BinaryType())])
    # one row per id, also where the documents repeat it
    one = sample.mapInArrow(features, schema).filter("x is not null").groupBy("id").agg(F.min(F.struct("x", "label")).alias("r")).select("id", "r.*")
    rows = sorted(one.collect(), key=lambda r: r.id)
    label = np.array([r.label for r in rows], np.int64)
    if len(set(label.tolist())) < 2:
        return MilModel(np.zeros(0), np.zeros(0), {}, constant=0.0 if 0 in label and 1 not in label else 1.0)
    mats = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in rows]
    bags = Bags(np.concatenate(mats), np.concatenate(([0], np.cumsum([len(m) for m in mats]))))
    model = train(bags, label)
    model.bias_shift = threshold_shift(model, bags, label)
    return model


def score(docs: DataFrame, model: MilModel, text_col: str = "text", out_col: str = "score", drop_text: bool = False) -> DataFrame:
    """Every row with its quality score (0 to 1) in ``out_col``."""
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c != out_col and not (drop_text and c == text_col)]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few KB, whatever the input
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out_col, T.DoubleType())])

    def run(batches):
        m = shared.value
        for b in tx.chunks(batches, text_col):
            s = m.score(passage_features(b.column(text_col)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(s, pa.float64())], names=[*kept, out_col])

    return docs.mapInArrow(run, schema)
