"""Quality: a regularised quadratic discriminant over document statistics.

One pass turns each whole text into a vector of transformed statistics (shares
under a square root, sizes under a logarithm; means over the text and the worst
window or block of it, so that junk inside a long text is seen).  The classes'
means and covariances come from sums that every labelled row adds to; sums of
outer products are mergeable, so training reads all labelled rows that are not
held out and only 2 * (1 + d + d * d) numbers reach the driver.

A class covariance is shrunk towards the pooled one (``to_pooled``) and that
towards its own diagonal (``to_diagonal``), both classes sharing a floor on
each variance.  Each class keeps the Cholesky factor of its covariance; a
document's score is the difference of the two log-densities, each from a
Mahalanobis distance by one triangular solve for a whole batch.  A logistic
curve, fitted on a bounded sample of ``curve_rows`` labelled rows, maps the
difference to a probability.

Empty or null texts have a defined vector (no words, everything zero) and are
scored like any other.  With labels of one class only, or none, every score is
that class's share (0.5 without labels).  Null labels are skipped.  Repeated
ids: every row is scored; a repeated label counts as often as it stands there.
Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import held_out, slices, staged
from devdelta.llm.toxicity import _logistic

WINDOW = 12
BLOCK = 50
TO_POOLED = 0.05
TO_DIAGONAL = 0.1
CURVE_ROWS = 20_000
NAMES = [
    "log_words",
    "word_length",
    "upper",
    "symbols",
    "bang",
    "digits",
    "again",
    "repeated",
    "duplicate_lines",
    "distinct",
    "no_letter",
    "worst_upper",
    "worst_symbols",
    "worst_bang",
    "worst_again",
    "worst_distinct",
    "worst_no_letter",
    "stops",
    "longest_run",
]


SPACE, ALPHA, UPPER, DIGIT, PLAIN, BANG, STOP = (1 << i for i in range(7))
_CODES = 1 << 16


def _character_classes() -> np.ndarray:
    out = np.zeros(_CODES, np.uint8)
    for code in range(_CODES):
        c = chr(code)
        out[code] = (
            SPACE * c.isspace()
            | ALPHA * c.isalpha()
            | UPPER * c.isupper()
            | DIGIT * c.isdigit()
            | PLAIN * (c.isalnum() or c in ".,;:!?'\"()-")
            | BANG * (c == "!")
            | STOP * (c in ".!?")
        )
    return out


_CLASS = _character_classes()


def text_vectors(texts: list[str | None]) -> np.ndarray:
    """The statistics of each text, worked out for a batch of texts at a time."""
    out = np.zeros((len(texts), len(NAMES)))
    codes = [np.frombuffer(f"{t or ''} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    chars = np.concatenate([np.full(1, 32, np.uint32), *codes])
    kind = np.where(chars < _CODES, _CLASS[np.minimum(chars, _CODES - 1)], np.uint8(ALPHA | PLAIN))
    inside = kind & SPACE == 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return out
    length = end - begin
    # sums over a word's characters, from running sums
    total = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[np.stack((begin, end))], axis=0)[0]
    letters = total(kind & ALPHA != 0)
    flags = np.stack(
        (
            (letters > 1) & (total(kind & UPPER != 0) == letters),
            total(kind & (PLAIN | SPACE) == 0) > 0,
            kind[end - 1] & BANG != 0,
            np.zeros(len(begin), bool),  # the word before again
            letters == 0,
            total(kind & DIGIT != 0) > 0,
            kind[end - 1] & STOP != 0,
        ),
        1,
    ).astype(np.float64)
    # a word's number: a hash of its characters and their places
    place = np.arange(len(chars), dtype=np.uint64)
    start_of = np.zeros(len(chars), np.uint64)
    start_of[begin] = np.diff(np.concatenate(([0], begin))).astype(np.uint64)
    place -= np.cumsum(start_of, dtype=np.uint64)
    x = chars + (place << np.uint64(32))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x[~inside] = 0
    word = np.add.reduceat(x, begin)
    text_end = np.cumsum([len(c) for c in codes]) + 1
    upto = np.searchsorted(begin, text_end)
    first = np.concatenate(([0], upto[:-1]))
    doc = np.repeat(np.arange(len(texts)), upto - first)
    flags[1:, 3] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    # words in windows of three that stand in the text twice
    repeated = np.zeros(len(word), bool)
    if len(word) > 2:
        gram = word[:-2] * np.uint64(0x9E3779B97F4A7C15) + word[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[2:]
        gram = (gram ^ (gram >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + doc[:-2].astype(np.uint64)
        within = np.flatnonzero(doc[:-2] == doc[2:])  # not from one text into the next
        order = within[np.argsort(gram[within], kind="stable")]
        same = gram[order[1:]] == gram[order[:-1]]
        twice = np.zeros(len(gram), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        for k in range(3):
            repeated[k : k + len(gram)] |= twice
    # words of a block of 50 that stand in it for the first time
    within = np.arange(len(word)) - np.repeat(first, upto - first)
    new_block = np.ones(len(word), bool)
    new_block[1:] = (within[1:] % BLOCK == 0) | (doc[1:] != doc[:-1])
    block = np.cumsum(new_block) - 1
    key = (word ^ (word >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD) + block.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(word), bool)
    fresh[order[1:]] = key[order[1:]] != key[order[:-1]]
    sums = np.concatenate((np.zeros((1, 7)), np.cumsum(flags, 0)))
    per_block = np.bincount(block)
    ratio = np.bincount(block, fresh) / per_block
    size = np.concatenate(([0], np.cumsum(length)))
    again = np.concatenate(([0], np.cumsum(repeated)))
    stops = np.flatnonzero(flags[:, 6])
    stop_at = np.searchsorted(stops, np.concatenate((first, upto[-1:])))
    root = np.sqrt
    for i, (a, b) in enumerate(zip(first.tolist(), upto.tolist())):
        n = b - a
        if not n:
            continue
        mean = (sums[b] - sums[a]) / n
        worst = ((sums[a + WINDOW : b + 1] - sums[a : b + 1 - WINDOW]) / WINDOW).max(0) if n > WINDOW else mean
        part = slice(block[a], block[b - 1] + 1)
        full = ratio[part][per_block[part] >= min(n, BLOCK // 2)]
        run = np.diff(np.concatenate(([a - 1], stops[stop_at[i] : stop_at[i + 1]], [b]))).max()
        lines = [x for x in texts[i].split("\n") if x.strip()]
        out[i] = (
            np.log1p(n),
            np.log1p((size[b] - size[a]) / n),
            root(mean[0]),
            root(mean[1]),
            root(mean[2]),
            root(mean[5]),
            root(mean[3]),
            root((again[b] - again[a]) / n),
            root(1 - len(set(lines)) / max(1, len(lines))),
            ratio[part].mean(),
            root(mean[4]),
            root(worst[0]),
            root(worst[1]),
            root(worst[2]),
            root(worst[3]),
            full.min(),
            root(worst[4]),
            root(mean[6]),
            np.log1p(run),
        )
    return out


def document_vectors(docs: DataFrame) -> DataFrame:
    """doc_id and the vector x of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            x = text_vectors(b["text"].to_pylist())
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def class_sums(known: DataFrame) -> dict[int, np.ndarray]:
    """For each class the sums of (1, x, x x'), added up by the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b["y"].to_numpy()
            x = _matrix(b["x"]) if b.num_rows else np.zeros((0, len(NAMES)))
            one = np.column_stack((np.ones(len(x)), x))
            for k in (0, 1):
                part = one[y == k]
                s = (part.T @ part).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), k), pa.int32()), pa.array(np.arange(len(s)), pa.int32()), pa.array(s)],
                    ["y", "i", "s"],
                )

    rows = known.select("y", "x").mapInArrow(run, "y int, i int, s double").groupBy("y", "i").agg(F.sum("s").alias("s")).collect()
    d = len(NAMES) + 1
    out = {0: np.zeros((d, d)), 1: np.zeros((d, d))}
    for r in rows:
        out[r["y"]][r["i"] // d, r["i"] % d] = r["s"]
    return out


@dataclass
class Discriminant:
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse of each Cholesky factor, worked out once
    log_dets: list[float]
    log_prior: float
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log p(x | 1) - log p(x | 0) + the log of the classes' odds, damped for the curve."""
        density = []
        for mean, inverse, log_det in zip(self.means, self.factors, self.log_dets):
            z = (x - mean) @ inverse.T
            density.append(-0.5 * ((z * z).sum(1) + log_det))
        raw = density[1] - density[0] + self.log_prior
        return np.sign(raw) * np.log1p(np.abs(raw))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -30, 30)))


def discriminant(sums: dict[int, np.ndarray], to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Discriminant | float:
    """The fitted discriminant, or the share of class 1 if there are not two classes."""
    n = [sums[k][0, 0] for k in (0, 1)]
    if min(n) < 2:
        return float(n[1] / sum(n)) if sum(n) else 0.5
    means = [sums[k][0, 1:] / n[k] for k in (0, 1)]
    spread = [sums[k][1:, 1:] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (spread[0] + spread[1]) / sum(n)
    pooled = (1 - to_diagonal) * pooled + to_diagonal * np.diag(np.diag(pooled))
    floor = np.diag(1e-4 + 0.01 * np.diag(pooled))
    factors, log_dets = [], []
    for k in (0, 1):
        own = (1 - to_pooled) * spread[k] / n[k] + to_pooled * pooled + floor
        lower = np.linalg.cholesky(own)
        factors.append(np.linalg.solve(lower, np.eye(len(lower))))
        log_dets.append(float(2 * np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, log_dets, float(np.log(n[1] / n[0])))


def fit(known: DataFrame, curve_rows: int = CURVE_ROWS) -> Discriminant | float:
    """Train on ``known`` (doc_id, y, x)."""
    model = discriminant(class_sums(known))
    if isinstance(model, float):
        return model
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(curve_rows).select("y", "x").toArrow()
    y, x = rows["y"].to_numpy(), _matrix(rows["x"].combine_chunks())
    if len(set(y.tolist())) == 2:
        model.slope, model.shift = _logistic(model.difference(x), y, np.full(len(y), 1 / len(y)))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; trained on ``labels`` (doc_id, quality)."""
    vectors = staged(document_vectors(docs), "quality-vectors")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id")))
    model = fit(vectors.join(known, "doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two matrices of 19 x 19

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if isinstance(m, float) or not b.num_rows:
                s = np.full(b.num_rows, m if isinstance(m, float) else 0.0)
            else:
                s = m.score(_matrix(b["x"]))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(s)], ["doc_id", "score"])

    scored = vectors.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
