"""Packing token ids into fixed-length sequences, shortest pack first.

1. A pass tokenizes each document (its ids and one end id) and cuts it: full
   sequences as long as they last, then the rest.  Only a row per piece is
   written: where it starts, its length and the checksum of its ids.
2. The histogram of the rests' lengths (at most ``size`` numbers) is packed on
   the driver, longest length first: the pieces of a length are placed into the
   open pack pattern that they fit with the most room left - the shortest pack
   first - and the counts of the patterns are updated; a pattern of which only
   a part is used is split.  The work depends on the number of lengths, not on
   the number of documents.
3. A pattern of count R stands for R sequences.  Each length's pieces are
   ranked over the whole corpus, and the rank leads to the pattern, the
   sequence and the offset.  Ranks come from counts per (length, group) with
   groups of rows dealt by a hash of the row's number, so neither a length that
   most pieces share (full sequences) nor a repeated row is ranked in one task.
   There are as many groups as the count of pieces asks for (``GROUP_ROWS``).  The slot table that a rank is looked
   up in holds a few thousand rows whatever the corpus's size.

A sequence's padded length is ``size``, except that a fill which is a power of
two needs none, so the patterns with room for it are left alone.

Tokenizer: words are independent in it (white space is dropped and no merge
crosses it), so ids are kept per distinct chunk between white space, in a
table of bounded size that a worker process keeps from task to task.

Null or empty text: the end id alone.  Repeated ids or rows: each row is packed
(its pieces share doc_id).  Empty table: no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from devdelta.llm.common import row_id, slices, staged

SIZE = 2048
END_ID = 1
GROUP_ROWS = 20_000  # pieces of a group that is ranked by one task, about
CHUNKS = 1_400_000  # distinct chunks whose ids are kept, some 200 MB a worker
#: Code points (first, last) of Unicode's White_Space, which the tokenizer's normaliser turns to blanks.
WHITE_SPACE = [(0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A)]
WHITE_SPACE += [(0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
WHITE = re.compile(f"[{''.join(chr(c) for a, b in WHITE_SPACE for c in range(a, b + 1))}]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


#: Ids of chunks that a worker process has met, for each tokenizer file.
_KNOWN: dict[str, dict[str, bytes]] = {}
#: Characters that Python's split also takes as white space, the tokenizer doesn't.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_TAIL = ".,;:!?"
WORD_END = "</w>"  # of the vocabulary's entries that end a word


class Ids:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, chunks: int = CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = chunks
        self.known = _KNOWN.setdefault(path, {})
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True

    @staticmethod
    def chunks(text: str | None) -> list[str]:
        if not text:
            return []
        return [c for c in WHITE.split(text) if c] if _SEPARATORS.search(text) else text.split()

    def learn(self, new: list[str]) -> None:
        """Ids of new chunks; letters before a tail of punctuation are a word of their own."""
        parts = {}
        for c in new:
            if c.isalpha():
                parts[c] = (c.lower() if c.isascii() else c,)
                continue
            core = c.rstrip(_TAIL)
            if not core.isalpha():
                parts[c] = (c,)
                continue
            # Case is dropped; outside ASCII that is left to the tokenizer.
            word = core.lower() if core.isascii() else core
            parts[c] = (word, c[len(core) :]) if len(core) < len(c) else (word,)
        known = self.known
        unknown = [w for w in {w for p in parts.values() for w in p} if w not in known]
        words = [w for w in unknown if w.isalpha()]
        self._encode([w for w in unknown if not w.isalpha()])
        for i in range(0, len(words), 4000):
            self._encode_words(words[i : i + 4000])
        for c, p in parts.items():
            if c not in known:
                known[c] = known[p[0]] if len(p) == 1 else known[p[0]] + known[p[1]]

    def _encode(self, chunks: list[str]) -> None:
        for c, e in zip(chunks, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False) if chunks else []):
            ids = e.ids
            self.known[c] = struct.pack(f"<{len(ids)}I", *ids)

    def _encode_words(self, words: list[str]) -> None:
        """Words of letters only, in one text: the last id of each is one that ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        last = np.flatnonzero(self.ends[ids]) + 1
        if len(last) != len(words) or last[-1] != len(ids):  # a letter that the normaliser takes apart
            self._encode(words)
            return
        data, edge = ids.tobytes(), [0, *(4 * last).tolist()]
        for w, a, b in zip(words, edge, edge[1:]):
            self.known[w] = data[a:b]

    def of(self, texts: list[str | None]) -> list[bytes]:
        chunks = [self.chunks(t) for t in texts]
        used = set(chain.from_iterable(chunks))
        new = used.difference(self.known)
        if new:
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
                new = used
            self.learn(list(new))
        get = self.known.__getitem__
        return [b"".join(map(get, c)) for c in chunks]


def cut(total: int, size: int) -> list[int]:
    """Lengths of a document's pieces: full sequences, then the rest."""
    return [size] * (total // size) + ([total % size] if total % size else [])


def document_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(tokenizer)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        for b in slices(batches, "text", 1 << 20):
            rows = []
            for doc, data in zip(b["doc_id"].to_pylist(), ids.of(b["text"].to_pylist())):
                data += end
                total, start = len(data) // 4, 0
                for n in cut(total, size):
                    rows.append((doc, start, n, zlib.crc32(data[4 * start : 4 * (start + n)]), total))
                    start += n
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (count, lengths) that place every length of the histogram as often as it occurs."""
    # room left -> patterns with that room, as counts of tuples of lengths
    open_packs: list[Counter] = [Counter() for _ in range(size + 1)]
    most = 0  # no pattern has more room
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = most
            while room >= length and not open_packs[room]:
                room -= 1
            most = room if room >= length else most
            if room < length:
                open_packs[size - length][(length,)] += left
                most, left = max(most, size - length), 0
                continue
            pattern, count = next(iter(open_packs[room].items()))
            used = min(count, left)
            if used == count:
                del open_packs[room][pattern]
            else:
                open_packs[room][pattern] -= used
            open_packs[room - length][(*pattern, length)] += used
            left -= used
    return sorted(((c, p) for packs in open_packs for p, c in packs.items()), key=lambda x: (x[1], x[0]))


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, offset): where the ranks of a length go, in order."""
    out: dict[int, list] = {}
    taken: Counter = Counter()
    sequence = 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            out.setdefault(length, []).append((taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return {k: np.array(v, np.int64) for k, v in out.items()}


def _look_up(table: dict[int, np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                rows = table[int(n)]
                at = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
                sequence[mine] = at[:, 1] + rank[mine] - at[:, 0]
                offset[mine] = at[:, 2]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(b[c] for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return run


def ranked(pieces: DataFrame, groups: int) -> DataFrame:
    """The pieces with ``rank``: 0, 1, ... within each length, over the whole table."""
    # Rows are dealt to groups by hash; a group's first rank is the count of the groups before it.
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(row_id(pieces)), F.lit(groups)))
    counts = dealt.groupBy("length", "grp").agg(F.count("*").alias("c"))
    before = Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "grp", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "grp").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = dealt.withColumn("n", F.row_number().over(within) - 1)
    return numbered.join(bases, ["length", "grp"]).withColumn("rank", F.col("base") + F.col("n")).drop("grp", "n", "base")


def pack(
    docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, end_id: int = END_ID, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """A row per piece with its sequence_id and offset, for ``docs`` (doc_id, text)."""
    pieces = staged(document_pieces(docs, tokenizer or default_tokenizer(), size, end_id), "pieces")
    histogram = {r["length"]: r["c"] for r in pieces.groupBy("length").agg(F.count("*").alias("c")).collect()}
    table = slots(shortest_pack_first(histogram, size))
    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    groups = -(-sum(histogram.values()) // group_rows)
    return ranked(pieces, max(1, groups)).mapInArrow(_look_up(table), ddl)
