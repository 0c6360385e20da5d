"""Similarity join of shingle sets by parity sketches.

A document's set: the distinct shingles of ``SHINGLE`` words (its words as one
shingle if there are fewer), as 64-bit hashes.  Sets a and b link when
``100 * |a & b| >= percent * |a | b|``, that is when their symmetric difference
is at most ``(100 - percent) * (|a| + |b|) / (100 + percent)``.

* Sketch: within a band of sizes the hash of each shingle is XORed into one of
  m words.  A shingle in only one of two sets changes one word, so the number of
  words that differ is at most the symmetric difference; with m above the
  band's largest difference d, linked sets agree in m - d words at least
  (pigeonhole).  Each set is joined by its words, those of its own band and, if
  it is large enough to have a partner there, of the next.  Words without a
  shingle tell nothing; a set with so many of them that a partner could agree in
  those alone is also joined by the choices of m - d of them.
* A second sketch of single bits (parities) is compared before any set is
  moved: its Hamming distance is at most the symmetric difference as well.
* What is left is verified on the sets themselves, worked out anew from the
  texts of the sets concerned.

Equal sets are one node (nodes are named by a hash of the set; a second hash
would show a clash, upon which other seeds are taken), so copies are neither
joined nor expanded.  Which nodes that share a word are compared:

1. each with the smallest of its word;
2. in rounds, as long as they connect and the pairs left in question shrink: each
   with a node of the word's largest component, chosen anew for every part of the
   words and round.  A group with many links soon is one component;
3. the rest by what tells them from a lead.  Of the words that still hold several
   components, every node is set beside the word's node L that is in most words: D elements
   are in only one of the two.  Two nodes differ in D + D' less twice the elements that
   both have in their lists, so linked ones have t >= (D + D' - d) / 2 in common, and of
   any fixed order one of the first D - t + 1.  The order begins with what few lists hold:
   shingles that L lacks and few others have, or that L has and few others lack; those
   that no other node in question has need not be joined at all.  D' is taken by
   levels of d / 8, so that t is close.

So no link between components is lost.  A node with d or more changes against the text
that a group varies has new shingles of its own, hardly fewer than its list's
first part, and forms no pairs, however many vary that text.  Unlinked nodes with
fewer changes (their differences lie between d and 2 d) may still be compared pair by
pair, if so few of them link that rounds don't connect them: an exact join has no linear
way for these.  The result is the components: links inside a component are not all
found, so it gives neither the list nor the number of links.

Hot groups: rows are distinct per batch before they are shuffled; a word's rows
are read as a sorted stream, never held; joins are on plain equality, so Spark
splits skewed sides.

Null or empty text, or text without words: an empty set, no links, a component
of its own.  Repeated ids: each row is a document; a component is named by its
smallest doc_id, null only if all are.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from devdelta.llm.common import ROW_ID, row_id, slices, staged, utf8
from devdelta.llm.components import connected

SHINGLE = 4
PERCENT = 85
FIRST_SIZE = 2
RATIO = 1.6
BAND_MASK = 63  # the low bits of a word: its band
LEAD_PARTS = 8  # parts of the words that choose their leads alike
LEVELS = 8  # levels of D for each difference that linked sets may have
SLICE = 1 << 18  # bytes of text that are cut into shingles together
SHRINK = 0.7  # a round that leaves more of the pairs in question is the last
MAX_SEEDS = 4

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z lower-cased, words between white space)."""
    raw = [utf8(t).lower() + b" " for t in texts]
    data = np.frombuffer(b" " + b"".join(raw), np.uint8)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return [np.zeros(0, np.uint64) for _ in texts]
    step = np.zeros(len(data), np.int64)
    step[begin] = np.diff(np.concatenate(([0], begin)))
    place = np.arange(len(data)) - np.cumsum(step)
    chars = _mix(data.astype(np.uint64) + (place.astype(np.uint64) << _U(8)) + _U(0x9E3779B97F4A7C15))
    chars[~inside] = 0
    word = _mix(np.add.reduceat(chars, begin) + (end - begin).astype(np.uint64))
    upto = np.searchsorted(begin, np.cumsum([len(r) for r in raw]) + 1)
    # a shingle of all words that a short text has gets its own number of words mixed in
    rolled = np.zeros(len(word), np.uint64)
    for k in range(size):
        n = len(word) - k
        if n > 0:
            rolled[:n] = _mix(rolled[:n] + word[k:] * _U(2 * k + 3))
    out, a = [], 0
    for b in upto.tolist():
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for w in word[a:b]:
                h = _mix(h * _U(31) + w + _U(b - a))
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
        a = b
    return out


@dataclass(frozen=True)
class Band:
    number: int
    low: int  # sizes of the band: low to high - 1
    high: int
    difference: int  # the largest symmetric difference of a linked pair
    words: int


class Bands:
    """The size bands up to any size."""

    def __init__(self, percent: int = PERCENT, first: int = FIRST_SIZE, ratio: float = RATIO):
        self.percent, self.ratio = percent, ratio
        self.bands: list[Band] = []
        self.next = first

    def difference(self, total: int) -> int:
        return (100 - self.percent) * total // (100 + self.percent)

    def band(self, number: int) -> Band:
        while len(self.bands) <= number:
            low = self.next
            high = max(low + 1, int(np.ceil(low * self.ratio)))
            d = self.difference(2 * (high - 1))
            self.bands.append(Band(len(self.bands), low, high, d, self._words(d, -(-self.percent * low // 100))))
            self.next = high
        return self.bands[number]

    @staticmethod
    def _words(d: int, least: int) -> int:
        """Enough words that a set of ``least`` shingles or more hardly ever leaves as many empty as linked sets share."""
        m = d + 4
        while m < 2 * d + 8:
            empty = m * float(np.exp(-least / m))
            if m - d >= 1.2 * empty + 3 * empty**0.5 + 2:
                break
            m += 1
        return m

    def of(self, n: int) -> list[Band]:
        """A set's own band, and the next if a partner may be there."""
        if n < self.band(0).low:
            return []
        i = 0
        while n >= self.band(i).high:
            i += 1
        own, after = self.band(i), self.band(i + 1)
        bands = [own, after] if 100 * n >= self.percent * after.low else [own]
        return [b for b in bands if b.difference]  # without a difference only equal sets link


def sketch_words(hashes: np.ndarray, band: Band, seed: int) -> tuple[np.ndarray, int]:
    """Join keys of a set in a band (signed 64-bit), and in how many of them a linked set agrees at least."""
    m = band.words
    h = _mix(hashes + _U(0x9E3779B97F4A7C15 * (2 * seed + 1) % 2**64))
    part = (((h >> _U(32)) * _U(m)) >> _U(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    word = np.bitwise_xor.reduceat(_mix(h[order] + _U(7)), first)
    code = part[first].astype(np.uint64) + _U(band.number << 40) + _U(seed << 56)
    keys = _mix(word ^ _mix(code))
    agree = m - band.difference
    if m - len(first) >= agree:
        empty = sorted(set(range(m)) - set(part[first].tolist()))
        more = [
            xxhash.xxh3_64_intdigest(np.array([seed, band.number, *c], np.int64).tobytes(), seed=1)
            for c in combinations(empty, agree)
        ]
        keys = np.concatenate((keys, np.array(more, np.uint64)))
    keys = (keys & ~_U(BAND_MASK)) | _U(band.number)
    return keys.view(np.int64), max(1, agree - (m - len(first)))


def bit_sketch(hashes: np.ndarray) -> bytes:
    """Parities of the set's shingles, half as many bits as shingles or more."""
    bits = 64
    while 2 * bits < len(hashes):
        bits *= 2
    parity = np.bincount((_mix(hashes + _U(11)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance; the longer sketch is folded to the shorter's length."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    x, y = np.bitwise_xor.reduce(x.reshape(-1, n)), np.bitwise_xor.reduce(y.reshape(-1, n))
    return int(np.bitwise_count(x ^ y).sum())


def _node(hashes: np.ndarray, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=seed) - 2**63


def _documents(seed: int, size: int):
    """uid, doc_id, text -> uid, doc_id, n, node, check (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            sets = shingle_sets(b["text"].to_pylist(), size)
            ids = [(_node(s, seed), _node(s, seed + 1000), bit_sketch(s)) if len(s) else (None,) * 3 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    b["uid"],
                    b["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([i[0] for i in ids], pa.int64()),
                    pa.array([i[1] for i in ids], pa.int64()),
                    pa.array([i[2] for i in ids], pa.binary()),
                ],
                ["uid", "doc_id", "n", "node", "check", "sketch"],
            )

    return run


def _emitted(seed: int, size: int, percent: int):
    """text -> word, node, need; the rows of equal sets once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for big in batches:
            seen: set[int] = set()
            for b in slices(iter([big]), "text", SLICE):
                words, nodes, needs, counts = [], [], [], []
                for s in shingle_sets(b["text"].to_pylist(), size):
                    if not len(s) or (node := _node(s, seed)) in seen:
                        continue
                    seen.add(node)
                    for band in bands.of(len(s)):
                        keys, need = sketch_words(s, band, seed)
                        words.append(keys)
                        needs.append(need)
                        nodes.append(node)
                        counts.append(len(keys))
                if words:
                    each = [pa.array(np.repeat(x, counts)) for x in (np.array(nodes, np.int64), np.array(needs, np.int32))]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(words)), *each], ["word", "node", "need"])

    return run


def _lists(percent: int):
    """lead, node, comp; n (size of the node's set), e (those of its shingles that other nodes have) and c (how many
    nodes have them); xn, xe, xc (the same of the lead); m (nodes beside the lead) -> key, side, node, comp:
    of nodes that link one has side 0 and one 1 of a key, or both 2."""

    def most(n: int) -> int:
        return (100 - percent) * n // (100 + percent)

    def taken(column: pa.Array, i: int) -> np.ndarray:
        return column[i].values.to_numpy() if column[i].is_valid else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = zip(*(batch[k].to_pylist() for k in ("lead", "node", "n", "xn", "m")))
            keys, sides, counts = [], [], []
            for i, (lead, node, n, xn, m) in enumerate(numbers):
                e, c, xe, xc = (taken(batch[k], i) for k in ("e", "c", "xe", "xc"))
                new, lacks = ~np.isin(e, xe, assume_unique=True), ~np.isin(xe, e, assume_unique=True)
                own = n - len(e)  # no other node has them: first of all, and without a partner
                only = np.arange(0 if node == lead else xn - len(xe)) + 1  # those that only the lead has are known by number
                row = np.concatenate((e[new], xe[lacks], only)).view(np.uint64)
                few = np.concatenate((c[new], np.maximum(1, m - xc[lacks]), np.full(len(only), m)))
                row = row[np.lexsort((row, few))]
                d, dmax = len(row) + own, most(n + 100 * n // percent)
                width = max(1, most(2 * xn) // LEVELS)
                level = d // width
                made = 0
                for other in range(max(0, d - dmax) // width, (d + dmax) // width + 1):
                    t = -(-(d + other * width - dmax) // 2)
                    part = row[: max(0, d - max(t, 1) + 1 - own)]
                    if t <= 0:
                        part = np.append(part, _U(0))  # may link without an element in common
                    place = _mix(np.array([lead, min(level, other) << 32 | max(level, other)], np.int64).view(np.uint64))
                    keys.append(_mix(part ^ place[0]) ^ place[1])
                    sides.append(np.full(len(part), 2 if level == other else int(level > other), np.int8))
                    made += len(part)
                counts.append(made)
            at = pa.array(np.repeat(np.arange(len(counts)), counts))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), pa.array(np.concatenate(sides) if sides else np.zeros(0, np.int8)), batch["node"].take(at), batch["comp"].take(at)],
                ["key", "side", "node", "comp"],
            )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by word and node -> those of words with several nodes, each once."""
    last = None  # a row whose word may go on in the next batch, and whether it was given out
    for b in batches:
        word, node, need = (b[c].to_numpy() for c in ("word", "node", "need"))
        if last is not None:
            word, node, need = (np.concatenate(([x], y)) for x, y in zip(last, (word, node, need)))
        if not len(word):
            continue
        fresh = np.ones(len(word), bool)
        fresh[1:] = (word[1:] != word[:-1]) | (node[1:] != node[:-1])
        word, node, need = word[fresh], node[fresh], need[fresh]
        same = word[1:] == word[:-1]
        out = np.zeros(len(word), bool)
        out[1:] |= same
        out[:-1] |= same
        if last is not None and last[3]:
            out[0] = False
        given = bool(len(same) and same[-1]) or bool(last is not None and last[3] and len(word) == 1)
        last = (word[-1], node[-1], need[-1], given)
        yield pa.RecordBatch.from_arrays(
            [pa.array(word[out]), pa.array(node[out]), pa.array(need[out].astype(np.int32))], ["word", "node", "need"]
        )


def _near(percent: int):
    """a, b with sizes and bit sketches -> the pairs that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for m, n, x, y in zip(*(batch[c].to_pylist() for c in ("na", "nb", "sa", "sb"))):
                small = 100 * min(m, n) >= percent * max(m, n)
                keep.append(small and sketch_distance(x, y) <= (100 - percent) * (m + n) // (100 + percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            sets = shingle_sets(b["text"].to_pylist(), size)
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b["node"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["node", "s"])

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i in range(b.num_rows):
                x, y = (b[c][i].values.to_numpy().view(np.uint64) for c in ("x", "y"))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b["a"].filter(mask), b["b"].filter(mask)], ["a", "b"])

    return run


WORDS_DDL = "word long, node long, need int"


class Join:
    """The join of one table; ``rows``: uid, doc_id, text."""

    def __init__(self, rows: DataFrame, percent: int, size: int):
        self.rows, self.percent, self.size = rows, percent, size
        ddl = f"uid {ROW_ID}, doc_id long, n long, node long, check long, sketch binary"
        for seed in range(MAX_SEEDS):
            docs = staged(rows.mapInArrow(_documents(seed, size), ddl), "shingle-sets")
            nodes = docs.where("n > 0").groupBy("node").agg(
                F.min("uid").alias("uid"), F.min("n").alias("n"), F.min("sketch").alias("sketch"), F.min("check").alias("c0"), F.max("check").alias("c1")
            )
            nodes = staged(nodes, "nodes")
            if nodes.where("c0 <> c1").isEmpty():
                self.seed, self.docs, self.nodes = seed, docs, nodes.drop("c0", "c1")
                return
        raise ValueError("sets clash under every seed")

    def members(self) -> DataFrame:
        """word, node, need of all words that several nodes share."""
        emitted = self.rows.select("text").mapInArrow(_emitted(self.seed, self.size, self.percent), WORDS_DDL)
        return self.shared(emitted, "members")

    @staticmethod
    def shared(emitted: DataFrame, name: str) -> DataFrame:
        dealt = emitted.repartition("word").sortWithinPartitions("word", "node")
        return staged(dealt.mapInArrow(_shared, WORDS_DDL), name)

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a < b) that size and bit sketch allow."""
        side = lambda x: self.nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
        return staged(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_near(self.percent), "a long, b long"), "near-pairs")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """node, s (sorted hashes) of the nodes given."""
        first = self.nodes.select("node", "uid").join(nodes, "node", "left_semi")
        found = self.rows.select("uid", "text").join(first, "uid").select("node", "text")
        return staged(found.mapInArrow(_sets(self.size), "node long, s array<long>"), "sets")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs that link."""
        both = pairs.join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
        both = both.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").select("a", "b", "x", "y")
        return staged(both.mapInArrow(_verified(self.percent), "a long, b long"), "links")

    def links(self) -> DataFrame:
        """Links between nodes that connect all that are connected."""
        members = self.members()
        leads = members.groupBy("word").agg(F.min("node").alias("a"), F.count("*").alias("k"))
        members = staged(members.join(leads, "word"), "led-members")
        tried = staged(members.where("a <> node").select("a", F.col("node").alias("b")).distinct(), "tried")
        near = self.near(tried)
        links = self.verified(near, self.sets(near.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
        label = connected(links)
        open_, left = self.open(members.where("k > 2").select("word", "node", "need"), label)  # of two nodes one was the lead
        if not left:
            return links
        sets = self.sets(open_.select("node").distinct())
        for turn in count():
            pairs = staged(self.with_leads(open_, turn).join(tried, ["a", "b"], "left_anti"), "lead-pairs")
            found = self.verified(self.near(pairs), sets)
            if found.isEmpty():
                break
            tried, links = tried.unionByName(pairs), links.unionByName(found)
            label = connected(links)
            before = left
            open_, left = self.open(open_.select("word", "node", "need"), label)
            if not left or left > SHRINK * before:
                break
        if not left:
            return links
        near = self.near(self.across(self.lists(self.rarest(open_), sets)).join(tried, ["a", "b"], "left_anti"))
        return links if near.isEmpty() else links.unionByName(self.verified(near, sets))

    def lists(self, open_: DataFrame, sets: DataFrame) -> DataFrame:
        """key, side, node, comp: what the nodes of ``open_`` differ in from a lead of each word."""
        often = open_.groupBy("node").agg(F.count("*").alias("often"))
        leads = open_.join(often, "node").groupBy("word").agg(F.max_by("node", F.struct("often", "node")).alias("lead"))
        beside = staged(open_.join(leads, "word").select("lead", "node", "comp").distinct(), "beside-leads")
        sizes = beside.groupBy("lead").agg(F.count("*").alias("m"))
        left = sets.join(beside.select("node").distinct(), "node", "left_semi")
        each = left.select("node", F.explode("s").alias("e"))
        common = each.groupBy("e").agg(F.count("*").alias("c")).where("c > 1")
        common = each.join(common, "e").groupBy("node").agg(F.collect_list(F.struct("e", "c")).alias("ec"))
        known = left.select("node", F.size("s").cast("long").alias("n")).join(common, "node", "left")
        known = staged(known.select("node", "n", F.col("ec.e").alias("e"), F.col("ec.c").alias("c")), "sets-in-question")
        whole = beside.join(known, "node").join(sizes, "lead").join(known.toDF("lead", "xn", "xe", "xc"), "lead")
        return whole.mapInArrow(_lists(self.percent), "key long, side byte, node long, comp long")

    @staticmethod
    def open(members: DataFrame, label: DataFrame) -> tuple[DataFrame, int]:
        """The rows of ``members`` whose word is shared by several components, with comp, kc (rows of the
        word and component) and k (rows of the word); and how many pairs of different components that makes."""
        placed = members.join(label, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
        parts = placed.groupBy("word", "comp").agg(F.count("*").alias("kc"))
        words = parts.groupBy("word").agg(F.count("*").alias("comps"), F.sum("kc").alias("k"), F.sum(F.col("kc") * F.col("kc")).alias("kk"))
        several = words.where("comps > 1").select("word", "k", "kk")
        open_ = staged(placed.join(several, "word").join(parts, ["word", "comp"]), "open-members")
        # every word's pairs, counted at its rows: k - kc partners each
        left = open_.agg(F.sum(F.col("k") - F.col("kc"))).first()[0] or 0
        return open_.drop("kk"), left // 2

    @staticmethod
    def with_leads(open_: DataFrame, turn: int) -> DataFrame:
        """Pairs (a < b) of every node with one of its word's largest component."""
        chance = F.xxhash64("node", F.pmod("word", F.lit(LEAD_PARTS)), F.lit(turn))  # many words share a lead
        first = open_.groupBy("word", "comp").agg(F.min("kc").alias("kc"), F.min_by("node", chance).alias("lead"), F.min(chance).alias("chance"))
        leads = first.groupBy("word").agg(F.max_by(F.struct("lead", "comp"), F.struct("kc", "chance")).alias("x"))
        met = open_.join(leads, "word").where("comp <> x.comp")
        return met.select(F.least("x.lead", "node").alias("a"), F.greatest("x.lead", "node").alias("b")).distinct()

    @staticmethod
    def rarest(members: DataFrame) -> DataFrame:
        """The rows of ``members`` that a link between components may still need.

        ``members`` holds all words in which a link may agree.  A node and its
        partner agree in ``need`` of them at least, so the rarest that they
        share isn't, for either, among the last ``need`` - 1 in order of
        frequency; a node with fewer than ``need`` has no partner.
        """
        own = Window.partitionBy("node", "band")  # the words of one set
        placed = members.withColumn("band", F.col("word").bitwiseAND(F.lit(BAND_MASK))).withColumns(
            {"z": F.count("*").over(own), "place": F.row_number().over(own.orderBy("k", "word"))}
        )
        return placed.where("place <= z - need + 1").select("word", "node", "comp")

    @staticmethod
    def across(listed: DataFrame) -> DataFrame:
        """Pairs (a < b) of nodes of different components that meet in a key."""
        keyed = staged(listed, "lists")
        x = keyed.select("key", F.col("node").alias("a"), F.col("comp").alias("ca"), F.col("side").alias("sa"))
        y = keyed.select("key", F.col("node").alias("b"), F.col("comp").alias("cb"), F.col("side").alias("sb"))
        return x.join(y, "key").where("ca <> cb and a < b and sa + sb in (1, 4)").select("a", "b").distinct()


def similar_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Besides, uid (the row's number) and kept (one row of each component: of its smallest doc_id).
    """
    rows = docs.select(
        row_id(docs).alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    join = Join(rows, percent, size)
    label = connected(join.links())
    placed = join.docs.select("uid", "doc_id", "n", "node").where("n > 0").join(label, "node", "left")
    placed = staged(placed.select("uid", "doc_id", "n", F.coalesce("label", "node").alias("comp")), "placed")
    first = placed.groupBy("comp").agg(
        F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "uid")).alias("one")
    )
    linked = placed.join(first, "comp").select(
        "uid", "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("uid") == F.col("one.uid")).alias("kept")
    )
    alone = join.docs.where("n = 0").select(
        "uid", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return linked.unionByName(alone)
