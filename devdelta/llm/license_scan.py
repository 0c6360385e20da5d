"""License notices: exact phrases and fuzzy search of short notices.

A text is normalised to words (A-Z lower-cased, words of letters, digits and
non-ASCII characters) joined by single spaces.

* Base phrases are found where their words stand consecutively.
* A notice of a label may also occur with up to ``k`` character edits (one for
  every 12 characters, three at most).  It is split into k + 1 pieces; any
  occurrence with k edits contains one piece unchanged (pigeonhole).  One
  automaton finds all pieces of all notices in one pass; in a window around
  each find, of the notice's length and k on both sides, the regex library
  matches the whole notice with at most k edits, which verifies the edits and
  gives the span.  A match begins and ends where words do.  Of overlapping matches of a notice the one with the fewest
  edits stays, and the rest of the others' windows is searched again.

Everything is worked out per document inside the scan; nothing is shuffled.  The
work is linear in a text's length; equal windows of a text are matched once.
Null or empty text: no words, no labels, score 0.  Empty table: no rows.
Repeated ids: every row is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import utf8

# Base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices searched with errors, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "proprietary",
}

_WORD = [c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)]
for _c in range(0x41, 0x5B):
    _WORD[_c] = _c + 32
_TABLE = bytes(_WORD)


def normalised(text: str | None) -> str:
    """The words of a text joined by single spaces."""
    return b" ".join(utf8(text).translate(_TABLE).split()).decode("utf-8", "surrogatepass")


def max_edits(notice: str) -> int:
    return min(3, len(notice) // 12)


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """The notice cut into k + 1 pieces: (offset, piece)."""
    cut = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cut, cut[1:])]


@lru_cache(maxsize=8)
def _searcher(notices: tuple[tuple[str, str], ...]):
    automaton = ahocorasick.Automaton()
    found: dict[str, list[tuple[int, int]]] = {}
    patterns = []
    for i, (notice, label) in enumerate(notices):
        k = max_edits(notice)
        patterns.append((regex.compile(f"(?b)(?<= )(?:{regex.escape(notice)}){{e<={k}}}(?= )"), len(notice), k, label))
        for offset, piece in pieces(notice, k):
            found.setdefault(piece, []).append((i, offset))
    for piece, where in found.items():
        automaton.add_word(piece, (len(piece), where))
    automaton.make_automaton()
    return automaton, patterns


class _Text:
    """A text's words with a blank on either side, and where the words begin."""

    def __init__(self, words: str):
        self.words = f" {words} "
        self.blanks: np.ndarray | None = None

    def word_numbers(self, places: list[int]) -> list[int]:
        """The number of the word at each place, from 0 (of the next word at a blank)."""
        if not places:
            return []
        if self.blanks is None:
            codes = np.frombuffer(self.words.encode("utf-32-le", "surrogatepass"), np.uint32)
            self.blanks = np.flatnonzero(codes == 32)
        return (np.searchsorted(self.blanks, np.array(places), "left") - 1).tolist()


def _disjoint(pattern: regex.Pattern, words: str, windows: set[tuple[int, int]], n: int, k: int) -> list[tuple[int, int, int]]:
    """(start, end, edits) of matches that don't overlap, those with the fewest edits first."""
    least = n - k
    known: dict[str, tuple[int, int, int] | None] = {}  # equal pieces of text are searched once

    def best(lo: int, hi: int) -> tuple[int, int, int, int, int] | None:
        """(edits, start, end, lo, hi) of the best match between two places; the blank before it counts as seen."""
        part = words[lo - 1 : hi]
        if part not in known:
            m = pattern.search(part, 1)
            known[part] = m and (sum(m.fuzzy_counts), m.start() - 1, m.end() - 1)
        found = known[part]
        return found and (found[0], lo + found[1], lo + found[2], lo, hi)

    heap = [m for lo, hi in windows if (m := best(lo, hi))]
    heapify(heap)
    kept: dict[int, list[tuple[int, int, int]]] = {}  # by start, in steps of the least length
    while heap:
        edits, start, end, lo, hi = heappop(heap)
        near = (x for s in range((start - n - k) // least, end // least + 1) for x in kept.get(s, ()))
        over = max((x for x in near if x[0] < end and x[1] > start), default=None)
        if over:
            for part in ((lo, over[0]), (over[1], hi)):
                if part[1] - part[0] >= least and (m := best(*part)):
                    heappush(heap, m)
        else:
            kept.setdefault(start // least, []).append((start, end, edits))
    return [x for some in kept.values() for x in some]


def fuzzy_matches(words: str, notices: tuple[tuple[str, str], ...]) -> list[tuple[str, int, int, int, int]]:
    """(label, start, end, edits, notice length) in ``words``: the spans of notices with a bounded number of edits."""
    automaton, patterns = _searcher(notices)
    words = f" {words} "
    windows: dict[int, set[tuple[int, int]]] = {}
    for end, (size, where) in automaton.iter(words):
        for i, offset in where:
            _, n, k, _ = patterns[i]
            at = end + 1 - size - offset
            windows.setdefault(i, set()).add((max(1, at - k), min(len(words), at + n + k + 1)))
    out = []
    for i, places in windows.items():
        pattern, n, k, label = patterns[i]
        out += [(label, a - 1, b - 1, e, n) for a, b, e in _disjoint(pattern, words, places, n, k)]
    return sorted(set(out), key=lambda m: (m[1], m[2], m[0]))


def base_places(text: _Text, phrases: tuple[tuple[str, str], ...]) -> list[tuple[int, str]]:
    """(first word's number, label) of every place where a phrase's words stand."""
    places, labels = [], []
    for phrase, label in phrases:
        at = text.words.find(f" {phrase} ")
        while at >= 0:
            places.append(at + 1)
            labels.append(label)
            at = text.words.find(f" {phrase} ", at + 1)
    return list(zip(text.word_numbers(places), labels))


def scan_text(text: str | None, phrases, notices) -> tuple:
    words = normalised(text)
    padded = _Text(words)
    base = base_places(padded, phrases)
    fuzzy = fuzzy_matches(words, notices)
    starts = [p for p, _ in base]
    base_labels = {x for _, x in base}
    score = 1.0 if base else max((1 - e / n for _, _, _, e, n in fuzzy), default=0.0)
    first = padded.word_numbers([a + 1 for _, a, _, _, _ in fuzzy])
    last = padded.word_numbers([b for _, _, b, _, _ in fuzzy])
    spans = [(m[0], a, b, m[3]) for m, a, b in zip(fuzzy, first, last)]
    return (
        words.count(" ") + 1 if words else 0,
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | {m[0] for m in fuzzy})),
        score,
        [{"label": x, "first_word": a, "last_word": b, "edits": e} for x, a, b, e in spans],
    )


SPAN = pa.struct(
    [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())]
)
FIELDS = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("spans", pa.list_(SPAN)),
]


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """Labels and spans of license notices in every row of ``docs`` (doc_id, text).

    ``spans`` holds label, first and last word and the edits of each fuzzy match.
    """
    base = tuple((phrases or BASE_PHRASES).items())
    fuzzy = tuple((notices or NOTICES).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scan_text(t, base, fuzzy) for t in b["text"].to_pylist()]
            cols = list(zip(*rows)) if rows else [[]] * len(FIELDS)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *(pa.array(c, t) for c, (_, t) in zip(cols, FIELDS))], ["doc_id", *(n for n, _ in FIELDS)]
            )

    ddl = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label: string, first_word: long, last_word: long, edits: int>>"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ddl)
