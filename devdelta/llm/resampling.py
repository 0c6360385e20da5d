"""Resampling of documents toward a target text distribution.

A document's features are all runs of 1 to 3 consecutive words, repeats
counted, hashed into ``BUCKETS`` buckets.  A bucket's gain is the log ratio of
its smoothed shares among the target's features and among all documents', in
whole thousandths; a document's weight is the sum over its features, looked up
in one array.  Gumbel noise, fixed by the document's id and a seed, is added, so
that the highest scores are a draw without replacement by those weights.

The draw needs the cutoff, the k-th highest score of N, but no sort of N rows:

* a mergeable quantile sketch of all scores gives a bracket around the cutoff;
* exact counts of the rows above and inside the bracket validate it; while the
  cutoff lies outside, the bracket is widened on that side;
* only the rows inside the bracket are sorted (by ranges, in many tasks), and the
  one at the place that the count above leaves is the cutoff.

Ranks of the drawn rows come from the same sort by ranges: place inside the
range plus the counts of the ranges before.  Drawn and undrawn rows are told
apart by comparing with the cutoff, so nothing is joined.

Words: after lower-casing A-Z, runs of digits, a-z and all characters beyond
ASCII.  Null or empty text: no features, weight 0, too few words to be drawn.
Null id: noise and order as of an empty id, after all others.  Repeated ids: each row
is a document; ties of score and id are broken by the row's place.  Empty target
or table: gains of the counts as they are (0 of 0), no rows from no documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import ROW_ID, row_id, slices, staged, utf8

BUCKETS = 10_000
RUNS = 3  # the longest run of words
SEED = 42
PERCENT = 5
LEAST_WORDS = 20
KLL_K = 800  # rank error of about 0.2 %
PIECE = 1_000  # buckets in one row of partial counts
LONG_WORD = 64

_LOW = np.zeros(256, np.uint8)  # A-Z lower-cased; 0 outside words
for _c in range(256):
    _x = _c + 32 if 65 <= _c <= 90 else _c
    if 48 <= _x <= 57 or 97 <= _x <= 122 or _x >= 128:
        _LOW[_c] = _x


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def _continued(state: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The crc32 of each text so far (``state``) with one more word of ``data`` after it."""
    order = np.argsort(-np.minimum(size, LONG_WORD + 1), kind="stable")
    at, left = begin[order], size[order]
    c = ~state[order]
    n_long = int(np.searchsorted(-left, -LONG_WORD))
    n = len(order) - np.searchsorted(left[::-1], np.arange(LONG_WORD) + 1)
    for k in range(LONG_WORD):
        m = int(n[k])
        if not m:
            break
        c[n_long:m] = _CRC[(c[n_long:m] ^ data[at[n_long:m] + k]) & 0xFF] ^ (c[n_long:m] >> np.uint32(8))
    out = np.empty_like(c)
    out[order] = ~c
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(data[begin[i] : begin[i] + size[i]].tobytes(), int(state[i]))
    return out


def features(texts: list[str | None], runs: int = RUNS, buckets: int = BUCKETS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of all runs of words, and in what text they are.

    Returns for each run length the buckets of the runs in order, for each run
    length the number of the text (as one array a row), and the words of each text.
    """
    raw = [utf8(t) for t in texts]
    data = _LOW[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    inside = data != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, size = edge[::2], edge[1::2] - edge[::2]
    ends = np.cumsum([len(r) + 1 for r in raw])
    upto = np.searchsorted(begin, ends)
    per_text = np.diff(np.concatenate(([0], upto))) if len(raw) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(raw)), per_text)
    found, where = [], []
    c = _continued(np.zeros(len(begin), np.uint32), data, begin, size)
    for r in range(runs):
        if r:
            # one more word after each run whose text goes on
            go = text[r:] == text[:-r] if len(text) > r else np.zeros(0, bool)
            keep = np.flatnonzero(go)
            c = full[keep]
            c = ~(_CRC[(~c ^ np.uint32(32)) & 0xFF] ^ (~c >> np.uint32(8)))  # the space between
            c = _continued(c, data, begin[keep + r], size[keep + r])
            at = keep
        else:
            at = np.arange(len(text))
        full = np.zeros(len(text), np.uint32)
        full[at] = c
        found.append((c % np.uint32(buckets)).astype(np.int64))
        where.append(text[at])
    return found, where, per_text


def _piece_rows(pieces: dict[int, np.ndarray]) -> pa.RecordBatch:
    values = pa.array([p.tolist() for p in pieces.values()], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), values], ["piece", "counts"])


def _counted(runs: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in slices(batches, "text", 1 << 20):
            for f in features(b["text"].to_pylist(), runs, buckets)[0]:
                total += np.bincount(f, minlength=buckets)
        if total.any():
            yield _piece_rows({i // PIECE: total[i : i + PIECE] for i in range(0, buckets, PIECE)})

    return run


def _piece_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, v in zip(b["piece"].to_pylist(), b["counts"]):
            v = v.values.to_numpy()
            total[i] = total[i] + v if i in total else v
    if total:
        yield _piece_rows(total)


def feature_counts(texts: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` (text) fall into each bucket."""
    ddl = "piece int, counts array<long>"
    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted(runs, buckets), ddl)
    total = np.zeros(buckets, np.int64)
    for r in parts.repartition("piece").mapInArrow(_piece_sums, ddl).collect():  # ``buckets`` numbers
        total[r["piece"] * PIECE : r["piece"] * PIECE + len(r["counts"])] = r["counts"]
    return total


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in whole thousandths, from the feature counts."""
    buckets = len(documents)
    s, t = documents.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(shared, runs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in slices(batches, "text", 1 << 20):
            found, where, words = features(b["text"].to_pylist(), runs, len(gain))
            weight, n = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for f, w in zip(found, where):
                upto = np.concatenate(([0], np.cumsum(gain[f])))
                first, last = np.searchsorted(w, np.arange(b.num_rows)), np.searchsorted(w, np.arange(b.num_rows), "right")
                weight += upto[last] - upto[first]
                n += last - first
            yield pa.RecordBatch.from_arrays(
                [b["uid"], b["doc_id"], pa.array(words.astype(np.int64)), pa.array(n), pa.array(weight)],
                ["uid", "doc_id", "n_words", "n_features", "weight"],
            )

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths from the id's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


#: Highest scores first, then smaller ids, then places.
ORDER = ["down", "no_id", "doc_id", "uid"]


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"down": -F.col("score"), "no_id": F.col("doc_id").isNull()})


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their places (from 1) in ORDER as ``rank``: sorted by ranges, in as many tasks as there are ranges."""
    dealt = _ordered(rows).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    place = F.monotonically_increasing_id()  # task in the upper 31 bits, place in the lower 33
    sorted_ = staged(dealt.withColumn("place", place).drop("down", "no_id"), "ranges")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    before, offsets = 0, []
    for r in sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():  # a row for each range
        offsets.append((r["part"], before))
        before += r["n"]
    offset = sorted_.sparkSession.createDataFrame(offsets, "part long, before long")
    joined = sorted_.withColumn("part", part.cast("long")).join(F.broadcast(offset), "part")
    return joined.withColumn("rank", F.col("before") + inside + 1).drop("part", "before", "place")


def bracket(scores: DataFrame, k: int, n: int, start: float = 0.004) -> tuple[int, int, int]:
    """low, high and the exact number of scores above ``high``: the k-th highest of n scores lies in low..high."""
    sketch = scores.agg(F.kll_sketch_agg_bigint("score", F.lit(KLL_K)).alias("s"), F.min("score").alias("least"), F.max("score").alias("most"))
    sketch = staged(sketch, "score-sketch")
    spread, high_out, low_out = start, True, True
    low = high = 0
    while True:
        ranks = [min(max(1 - k / n + x, 0.0), 1.0) for x in (-spread, spread)]
        got = sketch.select("least", "most", *(F.kll_sketch_get_quantile_bigint("s", F.lit(x)).alias(f"q{i}") for i, x in enumerate(ranks))).first()
        if low_out:
            low = got["least"] if ranks[0] == 0 else got["q0"]
        if high_out:
            high = got["most"] if ranks[1] == 1 else got["q1"]
        outside = scores.agg(F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score") >= low).alias("reach")).first()
        high_out, low_out = outside["above"] >= k, outside["reach"] < k
        if not high_out and not low_out:
            return low, high, outside["above"]
        spread *= 4


def cutoff(rows: DataFrame, k: int, n: int):
    """The row at place k of ``rows`` (score, doc_id, uid) in ORDER; k from 1 to n."""
    low, high, above = bracket(rows.select("score"), k, n)
    inside = ranked(rows.select("score", "doc_id", "uid").where(F.col("score").between(low, high)))
    return inside.where(F.col("rank") == k - above).first()


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    runs: int = RUNS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) for every row of ``docs`` (doc_id, text); ``target`` (text).

    Besides, uid (the row's number) and n_words.
    """
    rows = docs.select(
        row_id(docs).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    gain = gains(feature_counts(rows, runs, buckets), feature_counts(target, runs, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # ``buckets`` longs
    ddl = f"uid {ROW_ID}, doc_id long, n_words long, n_features long, weight long"
    weighed = rows.mapInArrow(_weighed(shared, runs), ddl)
    scored = staged(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    columns = ["uid", "doc_id", "n_words", "n_features", "weight", "score"]
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    k = percent * n // 100
    undrawn = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*columns, undrawn)
    last = cutoff(scored.where(able), k, n)
    same = F.col("score") == last["score"]
    if last["doc_id"] is None:
        nearer, equal = F.col("doc_id").isNotNull(), F.col("doc_id").isNull()
    else:
        nearer, equal = F.col("doc_id") < last["doc_id"], F.col("doc_id") == last["doc_id"]
    place = F.struct(F.lit(last["uid"]["f"]).alias("f"), F.lit(last["uid"]["r"]).alias("r"))
    up_to = (F.col("score") > last["score"]) | (same & F.coalesce(nearer | (equal & (F.col("uid") <= place)), F.lit(False)))
    drawn = able & up_to
    return ranked(scored.where(drawn)).select(*columns, "rank").unionByName(scored.where(~drawn).select(*columns, undrawn))
