"""Removal of long repeated byte strings with suffix arrays built shard by shard.

A byte is removed when a string of ``size`` bytes that covers it also starts
anywhere else in the table.  Every string of ``size`` bytes (a window) is dealt
to a shard by what it contains: its key is the smallest hash of its grams of
``GRAM`` bytes.  Equal windows have equal keys, so they meet in one shard;
consecutive windows with one key form a run, and a run is moved as one string,
not window by window.

1. A pass over the texts writes a row per run: key, place, number of windows
   and a 128-bit identity (the key and a hash of the bytes).
2. Runs are counted by identity and by key.  A key that occurs once, in a run
   that can't repeat itself, is done with.  Of all other keys one occurrence of
   each different run is fetched, and the run's count goes with it as a weight,
   so a passage in a million documents is sorted once.
3. A shard's runs are joined to one string; its suffixes are classified and
   sorted by induced sorting, the leftmost-smaller ones by recursive naming
   (suffix_array.py), and the permuted common prefixes tell which windows share
   ``size`` bytes with a neighbour in order.  A window is repeated if the
   weights of the suffixes that share it add up to two.
4. The windows found are joined to all occurrences of their runs and each
   text's removed intervals are united.

Hot keys: counts are pre-aggregated; joins are on plain equality, so Spark
splits skewed sides.  A key whose different runs exceed ``SHARD_BYTES`` (a line
that stands in very many texts) isn't put into one shard, which one task would
sort alone: its runs are texts of their own and are dealt again, by another hash
of the grams, with their weights.  What is still above the bound after
``LEVELS`` deals, strings that differ little in very many ways, is counted
window by window, by weight, through 128-bit digests: spread evenly, the same answer.  The shards are dealt over as many tasks as their bytes ask for
(``TASK_BYTES``), not over as few as their size on disk would allow.

Null or empty text: nothing removed.  Repeated ids: every row is a text of its
own (and equal rows repeat each other).  Very long texts are cut into stretches
of windows, of which each overlaps the next by ``size`` - 1 bytes.  Empty
table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import ROW_ID, row_id, slices, staged, utf8
from devdelta.llm.suffix_array import permuted_prefixes, suffix_array

SIZE = 400
GRAM = 64
STRETCH = 1 << 20  # windows of a text that are looked at together
BATCH = 1 << 20  # bytes of a shard's string
SHARD_BYTES = 4 << 20
TASK_BYTES = 16 << 20  # of shards, for one task
LEVELS = 3

_seed = np.random.default_rng(9)
_BYTE = _seed.integers(0, 2**64, 256, dtype=np.uint64)
_FOLD = _seed.integers(0, 2**63, 24, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray, gram: int, level: int) -> np.ndarray:
    """A hash of the ``gram`` (a power of two) bytes at each place, another one at each level."""
    h, width = _BYTE[data], 1
    for fold in _FOLD[: gram.bit_length() - 1]:
        h = h[:-width] * fold + h[width:]
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    for _ in range(level):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h


def _window_minima(h: np.ndarray, width: int) -> np.ndarray:
    n, m, step = len(h), h, 1
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    rest = width - step
    return np.minimum(m[: n - width + 1], m[rest : rest + n - width + 1])


def window_runs(data: np.ndarray, size: int, gram: int, level: int = 0, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key and start of each run of windows, and whether a run may repeat itself."""
    h = _gram_hashes(data, gram, level)
    width = size - gram + 1
    low = _window_minima(h, width)
    key = low * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(salt % 2**64)
    begins = np.ones(len(key), bool)
    begins[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(begins)
    # Two equal windows of one run: its smallest gram comes back, so the window
    # that begins with it isn't the run's last.
    again = np.zeros(len(key), bool)
    again[:-1] = (h[: len(key) - 1] == low[:-1]) & ~begins[1:]
    return key, start, np.logical_or.reduceat(again, start)


def _text_runs(data: bytes, size: int, gram: int, stretch: int, level: int, salt: int) -> Iterator[tuple]:
    """(key, start, windows, self, identity) of the runs of a text."""
    total = len(data) - size + 1
    for at in range(0, max(0, total), stretch):
        n = min(stretch, total - at)
        part = data[at : at + n + size - 1]
        key, start, own = window_runs(np.frombuffer(part, np.uint8), size, gram, level, salt)
        count = np.diff(np.concatenate((start, [n])))
        view = memoryview(part)
        for k, s, c, o in zip(key[start].view(np.int64).tolist(), start.tolist(), count.tolist(), own.tolist()):
            yield k, at + s, c, o, xxhash.xxh3_64_intdigest(view[s : s + c + size - 1]) - 2**63


def text_runs(rows: DataFrame, size: int, gram: int, stretch: int, level: int) -> DataFrame:
    """uid, c, key, start, n, own, cid of the runs of ``rows`` (uid, text, c, salt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        names = ["uid", "c", "key", "start", "n", "own", "cid"]
        for b in slices(batches, "text"):
            out = [
                (row, *r)
                for row, (text, salt) in enumerate(zip(b["text"].to_pylist(), b["salt"].to_pylist()))
                for r in _text_runs(text or b"", size, gram, stretch, level, salt)
            ]
            row, *cols = (pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types))
            yield pa.RecordBatch.from_arrays([b["uid"].take(row), b["c"].take(row), *cols], names)

    uid = rows.schema["uid"].dataType.simpleString()
    return rows.mapInArrow(run, f"uid {uid}, c long, key long, start long, n long, own boolean, cid long")


def _intervals(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


def repeated_windows(contents: list[bytes], size: int, weights: list[int] | None = None) -> list[np.ndarray]:
    """For each string, which of its windows occur again in it or in another one; a string of weight w stands for w."""
    lengths = np.array([len(c) for c in contents])
    ends = np.cumsum(lengths + 1)
    s = np.zeros(int(ends[-1]), np.int16)  # 0 stands between strings
    for c, e in zip(contents, ends):
        s[e - 1 - len(c) : e - 1] = np.frombuffer(c, np.uint8).astype(np.int16) + 1
    order = suffix_array(s, 257)
    far = permuted_prefixes(s, order)[order] >= size
    repeated = np.zeros(len(s), bool)
    repeated[order] = far | np.concatenate((far[1:], [False]))
    if weights is not None:
        repeated |= np.repeat(np.array(weights) > 1, lengths + 1)
    return [repeated[e - 1 - n : e - size] for n, e in zip(lengths, ends)]


SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
SPANS_DDL = "key long, cid long, spans array<struct<a: long, b: long>>"


def _shards(size: int, batch: int):
    """Rows sorted by key -> key, cid and the intervals of repeated windows."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = [_intervals(x) for x in repeated_windows([r[2] for r in rows], size, [r[3] for r in rows])]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(found, SPANS)],
            ["key", "cid", "spans"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        amount = 0
        for b in batches:
            for i in range(b.num_rows):
                row = (b["key"][i].as_py(), b["cid"][i].as_py(), b["content"][i].as_py(), b["c"][i].as_py())
                if amount >= batch and row[0] != held[-1][0]:
                    yield solve(held)
                    held, amount = [], 0
                held.append(row)
                amount += len(row[2])
        if held:
            yield solve(held)

    return run


def _digests(size: int):
    """key, cid, c, content -> a row per window with its digest and its run's weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "content", 64 << 10):
            out: tuple[list, ...] = ([], [], [], [], [])
            for k, i, c, content in zip(*(b[n].to_pylist() for n in ("key", "cid", "c", "content"))):
                view = memoryview(content)
                for a in range(len(content) - size + 1):
                    for col, v in zip(out, (k, i, c, a, xxhash.xxh3_128_digest(view[a : a + size]))):
                        col.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["key", "cid", "c", "a", "digest"])

    return run


def _fetch(size: int):
    """text and its wanted runs -> key, cid, c, content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = []
            for data, wanted in zip(b["text"].to_pylist(), b["wanted"].to_pylist()):
                out += [(w["key"], w["cid"], w["c"], data[w["start"] : w["start"] + w["n"] + size - 1]) for w in wanted]
            cols = list(zip(*out)) if out else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["key", "cid", "c", "content"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text and intervals (a, b) -> the digest columns."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for b in slices(batches, "text"):
        out = []
        for doc, text, spans in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["spans"].to_pylist()):
            data = utf8(text)
            merged: list[list[int]] = []
            for x in sorted((x["a"], x["b"]) for x in spans or []):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            kept, at = hashlib.sha256(), 0
            for x, y in merged:
                kept.update(data[at:x])
                at = y
            kept.update(data[at:])
            out.append((doc, len(data), sum(y - x for x, y in merged), len(merged), kept.hexdigest()))
        cols = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def repeated_intervals(
    rows: DataFrame,
    size: int = SIZE,
    gram: int = GRAM,
    stretch: int = STRETCH,
    batch: int = BATCH,
    shard_bytes: int = SHARD_BYTES,
    task_bytes: int = TASK_BYTES,
    level: int = 0,
) -> DataFrame:
    """uid and the byte intervals (a, b) of ``rows`` (uid, text as binary, c, salt) that repeated strings cover.

    A text counts ``c`` times; ``salt`` keeps the keys of texts apart that cannot have a string in common.
    """
    runs = staged(text_runs(rows, size, gram, stretch, level), "runs")
    by_cid = runs.groupBy("key", "cid").agg(
        F.sum("c").alias("c"), F.max("own").alias("own"), F.min(F.struct("uid", "start")).alias("at"), F.max("n").alias("n")
    )
    by_cid = staged(by_cid, "run-identities")
    by_key = by_cid.groupBy("key").agg(F.sum("c").alias("total"), F.max("own").alias("own"), F.sum(F.col("n") + (size - 1)).alias("bytes"))
    by_key = by_key.where("total > 1 or own").select("key", "bytes")
    look = staged(by_cid.drop("own").join(by_key, "key"), "run-marks")

    wanted = look.groupBy("at.uid").agg(F.collect_list(F.struct("key", "cid", "c", "at.start", "n")).alias("wanted"))  # of one text
    fetched = rows.join(wanted, "uid").select("text", "wanted").mapInArrow(_fetch(size), "key long, cid long, c long, content binary")
    held, most = look.agg(F.coalesce(F.sum(F.col("n") + (size - 1)), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    some_hot = most > shard_bytes
    hot = look.where(F.col("bytes") > shard_bytes).select("key").distinct()
    if some_hot:
        fetched = staged(fetched, "run-contents")
    plain = fetched.join(hot, "key", "left_anti") if some_hot else fetched
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // task_bytes))
    plain = plain.repartition(tasks, "key").sortWithinPartitions("key", "cid")
    found = plain.mapInArrow(_shards(size, batch), SPANS_DDL).where(F.size("spans") > 0)
    if some_hot and level + 1 < LEVELS:
        again = fetched.join(hot, "key", "left_semi")
        again = again.select(F.struct("key", "cid").alias("uid"), F.col("content").alias("text"), "c", F.col("key").alias("salt"))
        inner = repeated_intervals(again, size, gram, stretch, batch, shard_bytes, task_bytes, level + 1)
        one: Column = F.struct("a", (F.col("b") - (size - 1)).alias("b"))
        found = found.unionByName(inner.groupBy("uid.key", "uid.cid").agg(F.collect_list(one).alias("spans")))  # of one run
    elif some_hot:
        windows = fetched.join(hot, "key", "left_semi").mapInArrow(_digests(size), "key long, cid long, c long, a long, digest binary")
        windows = staged(windows, "windows")
        twice = windows.groupBy("digest").agg(F.sum("c").alias("c")).where("c > 1").select("digest")
        one = F.struct("a", (F.col("a") + 1).alias("b"))
        singles = windows.join(twice, "digest").groupBy("key", "cid").agg(F.collect_list(one).alias("spans"))  # of one run
        found = found.unionByName(singles)

    flagged = staged(found, "run-spans")
    hits = runs.select("uid", "key", "cid", "start").join(flagged, ["key", "cid"])
    hits = hits.select("uid", "start", F.explode("spans").alias("x"))
    return hits.select("uid", (F.col("start") + F.col("x.a")).alias("a"), (F.col("start") + F.col("x.b") + (size - 1)).alias("b"))


def remove_repeats(docs: DataFrame, size: int = SIZE, **options: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        row_id(docs).alias("uid"),
    )
    texts = rows.select("uid", F.col("text").cast("binary").alias("text"), F.lit(1).cast("long").alias("c"), F.lit(0).cast("long").alias("salt"))
    found = repeated_intervals(texts, size, **options)
    spans = found.groupBy("uid").agg(F.collect_list(F.struct("a", "b")).alias("spans"))  # of one text
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.join(spans, "uid", "left").select("doc_id", "text", "spans").mapInArrow(_cut, ddl)
