"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character 3- to 5-grams (with the separators at its ends),
hashed to rows of one embedding table.  The vectors of a bag are averaged to a
word's vector, those of a window of words to the window's, and a linear softmax
tells the classes apart; table and softmax are trained jointly in numpy.  Since
words share n-grams, an unseen misspelling is near the words that it imitates.

A toxic passage in a long text is diluted by the rest, so the window (of 5
words), not the text, is what is averaged, and a document is scored by its
strongest window.  Training begins with whole texts, so that words that only
toxic texts have stand out before any window is chosen, and then picks the strongest
window of each document again in every round; both parts have at least a number
of gradient steps, however few the texts.  The strongest window's logit is mapped to a probability by a
logistic curve, fitted on documents that the embeddings were not trained on
and weighted to the classes' shares among all labels.

Training takes a bounded sample: at most ``per_class`` labelled documents of
each class, none held out, of texts up to ``train_chars`` characters.  All
texts are scored whole, from first to last word.  Both layers are linear, so
scoring needs one number per word; the broadcast model is a table of
``BUCKETS`` floats.

Empty or null texts have no window: their score is that of the weakest
evidence, MIN_LOGIT.  With labels of one class only, or none, every score is
that class's share.  Null labels are skipped.  Repeated ids: every row is
scored.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import held_out, slices

BUCKETS = 1 << 18
DIM = 8
WINDOW = 5
PER_CLASS = 2000
TRAIN_CHARS = 8_000
WHOLE_STEPS = 100  # gradient steps on whole texts, at least
STEPS = 200  # gradient steps on windows, at least
BATCH = 128
MIN_LOGIT = -12.0
_TABLE_SIZE = 1 << 16


def _word_characters() -> np.ndarray:
    """Which code points below 65,536 stand in words; all above do."""
    return np.fromiter((chr(c).isalnum() for c in range(_TABLE_SIZE)), bool, _TABLE_SIZE)


_IS_WORD = _word_characters()


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts as bags of table rows.

    Returns the rows of all bags one after the other, the bag sizes, and the
    number of words of each text.  A word is a run of letters and digits; its
    grams may take in the separator (one code) on either side.
    """
    codes = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    chars = np.concatenate([x for c in codes for x in (c, np.zeros(1, np.uint32))] + [np.zeros(5, np.uint32)])
    chars = np.concatenate((np.zeros(1, np.uint32), chars))
    word = _IS_WORD[np.minimum(chars, _TABLE_SIZE - 1)] | (chars >= _TABLE_SIZE)
    chars[~word] = 0
    inside = word[1:-4]  # the gram that starts one before belongs to this word
    begins = inside & ~word[:-5]
    ends = np.cumsum([len(c) + 1 for c in codes])
    number = np.cumsum(begins)
    per_text = np.diff(np.concatenate(([0], number[ends - 1]))) if len(texts) else np.zeros(0, np.int64)
    h = chars[: len(inside)].copy()
    rows = np.empty((len(inside), 3), np.int32)
    valid = np.empty((len(inside), 3), bool)
    valid[:, 0] = inside
    valid[:, 1] = inside & word[2:-3]
    valid[:, 2] = valid[:, 1] & word[3:-2]
    for n in range(1, 5):
        h *= np.uint32(0x01000193)
        h += chars[n : n + len(inside)]
        if n >= 2:
            x = h ^ (h >> np.uint32(15))
            x *= np.uint32(0x2C1B3C6D + 2 * n)
            x ^= x >> np.uint32(13)
            rows[:, n - 2] = x & np.uint32(BUCKETS - 1)
    size = np.add.reduceat(valid.sum(1), np.flatnonzero(begins)) if number[-1:].any() else np.zeros(0, np.int64)
    return rows[valid], size, per_text


@dataclass
class Model:
    weight: np.ndarray  # per bucket: embedding times the difference of the softmax rows
    bias: float
    slope: float
    shift: float

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))


def strongest(u: np.ndarray, window: int = WINDOW) -> tuple[float, int]:
    """The largest mean over windows of word values, and where that window starts."""
    if len(u) <= window:
        return (float(u.mean()), 0) if len(u) else (MIN_LOGIT, 0)
    c = np.concatenate(([0.0], np.cumsum(u)))
    means = (c[window:] - c[:-window]) / window
    at = int(means.argmax())
    return float(means[at]), at


def word_values(per_bucket: np.ndarray, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The mean over each bag."""
    if not len(size):
        return np.zeros(0)
    return np.add.reduceat(per_bucket[ids], np.cumsum(size) - size, dtype=np.float64) / size


class Trainer:
    """Jointly trains the embedding table and the softmax over a bounded sample of texts."""

    def __init__(self, texts: list[str], seed: int = 7):
        parts = [bags(texts[i : i + 64]) for i in range(0, len(texts), 64)]  # few texts' working arrays at a time
        self.ids, self.size, per_text = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        self.size = self.size.astype(np.int32)
        self.start = np.concatenate(([0], np.cumsum(self.size, dtype=np.int64)))
        edge = np.concatenate(([0], np.cumsum(per_text)))
        self.docs = [np.arange(a, b) for a, b in zip(edge, edge[1:])]
        rng = self.rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
        self.soft = rng.normal(0, 0.3, (2, DIM))
        self.bias = np.zeros(2)
        self.seen = np.full((BUCKETS, DIM), 1e-2, np.float32)

    def word_values(self) -> np.ndarray:
        """Of all words, some at a time."""
        per_bucket = (self.table @ (self.soft[1] - self.soft[0])).astype(np.float32)
        out = np.empty(len(self.size), np.float32)
        for a in range(0, len(out), 1 << 16):
            b = min(a + (1 << 16), len(out))
            out[a:b] = word_values(per_bucket, self.ids[self.start[a] : self.start[b]], self.size[a:b])
        return out

    def epoch(self, windows: list[np.ndarray], labels: np.ndarray, rate: float, batch: int = BATCH) -> None:
        order = self.rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            words = np.concatenate([windows[j] for j in part])
            per = np.array([len(windows[j]) for j in part])
            row = np.repeat(np.arange(len(part)), per)
            n = self.size[words]
            # the bags of all words of the batch, one after the other
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[words], n)
            ids, row, share = self.ids[at], np.repeat(row, n), np.repeat(1 / (n * per[row]), n)
            # sum each bucket's share per window
            v = np.stack([np.bincount(row, share * self.table[ids, k], len(part)) for k in range(DIM)], 1)
            z = v @ self.soft.T + self.bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            p /= len(part)
            by_v, by_soft = p @ self.soft, p.T @ v
            used, back = np.unique(ids, return_inverse=True)
            for k in range(DIM):
                g = np.bincount(back, share * by_v[row, k], len(used))
                self.seen[used, k] += (g * len(part)) ** 2
                self.table[used, k] -= rate * g * len(part) / np.sqrt(self.seen[used, k])
            self.soft -= rate * by_soft
            self.bias -= rate * p.sum(0)

    def windows(self, docs: list[int], values: np.ndarray | None) -> list[np.ndarray]:
        out = []
        for d in docs:
            ids = self.docs[d]
            if values is None or len(ids) <= WINDOW:
                at = int(self.rng.integers(0, max(1, len(ids) - WINDOW + 1)))
            else:
                at = strongest(values[ids])[1]
            out.append(ids[at : at + WINDOW])
        return out


def fit(texts: list[str], labels: list[int], shares: tuple[float, float], whole_steps: int = WHOLE_STEPS, steps: int = STEPS) -> Model:
    """Train on texts and labels (0 or 1); ``shares``: of the classes among all labels."""
    y = np.array(labels, np.int64)
    keep = [i for i, t in enumerate(texts) if any(map(str.isalnum, t))]
    if len(set(y[keep].tolist())) < 2:
        p = min(max(shares[1], 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, float(np.log(p / (1 - p))))
    trainer = Trainer(texts)
    train = [i for n, i in enumerate(keep) if n % 4]
    rest = [i for n, i in enumerate(keep) if n % 4 == 0]
    if len(set(y[rest].tolist())) < 2 or len(set(y[train].tolist())) < 2:
        train = rest = keep
    a_round = -(-len(train) // BATCH)
    for _ in range(-(-whole_steps // a_round)):
        trainer.epoch([trainer.docs[i] for i in train], y[train], 0.3)
    docs = train + [i for i in train if y[i] == 0]
    for _ in range(-(-steps // a_round)):
        values = trainer.word_values()
        picked = trainer.windows(train, values) + trainer.windows([i for i in train if y[i] == 0], None)
        trainer.epoch(picked, y[docs], 0.3)
    values = trainer.word_values()
    bias = float(trainer.bias[1] - trainer.bias[0])
    x = np.array([strongest(values[trainer.docs[i]])[0] for i in rest]) + bias
    target = y[rest]
    weight = np.where(target == 1, shares[1] / max(1, (target == 1).sum()), shares[0] / max(1, (target == 0).sum()))
    slope, shift = _logistic(x, target, weight / weight.sum())
    return Model((trainer.table @ (trainer.soft[1] - trainer.soft[0])).astype(np.float32), bias, slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, least: float = 0.05) -> tuple[float, float]:
    """Slope and shift of a weighted, slightly regularised logistic curve (Newton steps).

    A stronger logit never counts for less: the slope is ``least`` a standard deviation or more.
    """
    mean, spread = float(x.mean()), float(x.std()) or 1.0
    a = np.stack([(x - mean) / spread, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (weight * (p - y)) + 1e-4 * w * np.array([1, 0]))
        w -= np.clip(step, -2, 2)
        w[0] = max(w[0], least)
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, train_chars: int) -> tuple[list, list, tuple]:
    """Texts and labels of a bounded sample, and the classes' shares among all labels that may be learnt."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values()) or 1
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = known.where("y = 0").orderBy(*order).limit(per_class).unionByName(known.where("y = 1").orderBy(*order).limit(per_class))
    ids = ids.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .where(F.length("text").between(1, train_chars))
        .join(F.broadcast(ids), "doc_id")  # at most 2 * per_class rows
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("y").alias("y"))
        .orderBy("doc_id")
        .collect()
    )
    return [r["text"] for r in rows], [r["y"] for r in rows], (counts.get(0, 0) / total, counts.get(1, 0) / total)


def _logits(model: Model, texts: list[str | None]) -> np.ndarray:
    ids, size, per_text = bags(texts)
    u = word_values(model.weight, ids, size)
    edge = np.cumsum(per_text)
    return np.array([strongest(u[e - n : e])[0] + model.bias if n else MIN_LOGIT for e, n in zip(edge, per_text)], np.float64)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the strongest window's logit for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text", 1 << 20):
            x = _logits(m, b["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(m.probability(x)), pa.array(x)], ["doc_id", "score", "logit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, logit double")


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, train_chars: int = TRAIN_CHARS) -> Model:
    """The model trained on ``labels`` (doc_id, toxic) of ``docs`` that are not held out."""
    return fit(*sample(docs, labels, label, per_class, train_chars))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text", 1 << 20):
            yield b.filter(pa.array(m.probability(_logits(m, b["text"].to_pylist())) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = PER_CLASS,
    train_chars: int = TRAIN_CHARS,
    threshold: float = 0.3,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; trained on ``labels`` (doc_id, toxic)."""
    scored = score_texts(docs, fitted(docs, labels, label, per_class, train_chars))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
