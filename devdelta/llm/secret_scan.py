"""Secret scan with multipart credential linking.

Strong finds stand for themselves: assignments of passwords, secrets, tokens and
API keys, access key ids, and long hexadecimal runs.  Credentials often come in
parts that mean little alone: who (an access identifier), what (a secret) and
where (an endpoint).  Such parts are weak candidates, found by their own
patterns: a user or key name, a value assigned to a name such as ``pwd`` or a
run of mixed characters of high entropy, a URL or an assigned host.

An interval join tells which weak candidates are reported: every part's interval
is stretched by ``reach`` characters on both sides, and a part counts only if an
interval of a complementary part meets it inside the same scope (a block of lines
without an empty line between).  Secrets complement identifiers and endpoints, and
these complement secrets; strong finds take part in their role (access key ids as
identifiers, the others as secrets) but are reported in any case.  The join is a
sweep over the parts of a text in order of place, forth and back, keeping for
each role the nearest end or start so far: linear in the number of parts.
All parts of a scope lie in one document, so no rows are shuffled.

Patterns match leftmost, without overlap; letters of names in either case, ASCII
only.  Weak candidates that overlap a strong find, or a weak one that begins
before (at the same place: is longer), are not candidates.  Places are code points, ends
exclusive.  Null or empty text: nothing found.  Null and repeated ids: every row
is returned.  Very long texts: all patterns and the sweep are linear.  Empty
table: no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import slices

REACH = 200  # characters between two linked parts at most
LEAST_ENTROPY = 3.5  # bits a character of an opaque run

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGNED = re.compile("password|passwd|secret|token|api_?key", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # of AKIA[A-Z0-9]+ those of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")
SECRET, IDENTIFIER, ENDPOINT = "secret", "identifier", "endpoint"
#: Kinds in the order in which spans of one start are listed, and their role.
KINDS = {"assign": SECRET, "access": IDENTIFIER, "hex": SECRET, "identifier": IDENTIFIER, "secret": SECRET, "endpoint": ENDPOINT}
BASE = ("assign", "access", "hex")
RANK = {k: i for i, k in enumerate(KINDS)}
#: role -> the roles that complement it
COMPLEMENTS = {SECRET: (IDENTIFIER, ENDPOINT), IDENTIFIER: (SECRET,), ENDPOINT: (SECRET,)}

_ASSIGNS = r"""["']?\x20*[:=]\x20*["']?"""
WEAK = {
    "identifier": re.compile(
        r"(?<![a-z0-9])(?:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?id|(?:access_?)?key_?id)"
        + _ASSIGNS
        + r"[A-Za-z0-9+/_.@=-]{3,}"
        + r"|(?<![A-Za-z0-9])(?-i:A[GIS][IDP]A[A-Z0-9]{12,})",
        re.ASCII | re.IGNORECASE,
    ),
    "secret": re.compile(
        r"(?<![a-z0-9])(?:pwd|pass(?:phrase|code)?|auth(?:orization)?|bearer|credentials?|private_?key|access_?key)"
        + _ASSIGNS
        + r"[A-Za-z0-9+/_.=-]{6,}",
        re.ASCII | re.IGNORECASE,
    ),
    "endpoint": re.compile(
        r"(?<![a-z0-9])(?:[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~:@%/?&=+-]{4,}"
        r"|(?:host(?:_?name)?|endpoint|server|region|bucket|url)" + _ASSIGNS + r"[A-Za-z0-9._:/-]{4,})",
        re.ASCII | re.IGNORECASE,
    ),
}
#: Any of these stands in a text with an assigned or addressed weak candidate.
_HINT = re.compile(r"[:=]")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,128}(?![A-Za-z0-9+/_-])")
BLANK = re.compile(r"\n[\t\r\x20]*(?=\n)")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if ASSIGNED.search(text):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def opaque(run: str) -> bool:
    """Upper and lower case, digits, and high entropy: no word or number."""
    if not (any(map(str.isdigit, run)) and any(map(str.islower, run)) and any(map(str.isupper, run))):
        return False
    n = len(run)
    return -sum(c / n * math.log2(c / n) for c in Counter(run).values()) >= LEAST_ENTROPY


def weak_spans(text: str, strong: list[Span]) -> list[Span]:
    """Weak candidates clear of strong finds and of each other, in order of place."""
    found: list[Span] = []
    if _HINT.search(text):
        for kind, pattern in WEAK.items():
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    found += [(m.start(), m.end(), "secret") for m in OPAQUE.finditer(text) if opaque(m[0])]
    if not found:
        return []
    found.sort(key=lambda s: (s[0], -s[1], RANK[s[2]]))
    taken = sorted((s, e) for s, e, _ in strong)
    out: list[Span] = []
    upto, i, hard = 0, 0, 0  # hard: the furthest end of strong finds that begin before
    for s, e, kind in found:
        while i < len(taken) and taken[i][0] <= s:
            hard = max(hard, taken[i][1])
            i += 1
        if s >= upto and s >= hard and (i == len(taken) or taken[i][0] >= e):
            out.append((s, e, kind))
            upto = e
    return out


def linked(text: str, parts: list[Span], reach: int = REACH) -> list[bool]:
    """Which of ``parts`` (sorted) meet a complementary part within ``reach`` in their scope."""
    met = [False] * len(parts)
    bounds = [m.start() for m in BLANK.finditer(text)] if len(parts) > 1 else []
    scopes, k = [], 0
    for s, _, _ in parts:
        while k < len(bounds) and bounds[k] < s:
            k += 1
        scopes.append(k)
    near: dict[str, int] = {}  # role -> furthest end so far
    for i, (s, e, kind) in enumerate(parts):
        if i and scopes[i] != scopes[i - 1]:
            near = {}
        met[i] = any(s - near[r] <= reach for r in COMPLEMENTS[KINDS[kind]] if r in near)
        near[KINDS[kind]] = max(e, near.get(KINDS[kind], 0))
    near = {}  # role -> nearest start so far
    for i in range(len(parts) - 1, -1, -1):
        s, e, kind = parts[i]
        if i + 1 < len(parts) and scopes[i] != scopes[i + 1]:
            near = {}
        met[i] = met[i] or any(near[r] - e <= reach for r in COMPLEMENTS[KINDS[kind]] if r in near)
        near[KINDS[kind]] = s
    return met


def scan_text(text: str | None, reach: int = REACH) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, by start and kind."""
    if not text:
        return [], []
    order = lambda s: (s[0], RANK[s[2]], s[1])
    base = sorted(base_spans(text), key=order)
    weak = weak_spans(text, base)
    if not weak:
        return base, base
    parts = sorted(base + weak, key=order)
    met = linked(text, parts, reach)
    return base, [p for p, m in zip(parts, met) if m or p[2] in BASE]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


OUTPUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scanned(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            counts: dict[str, list[int]] = {k: [] for k in BASE}
            hashes, spans = [], []
            for t in b["text"].to_pylist():
                base, every = scan_text(t, reach)
                for k in BASE:
                    counts[k].append(sum(x[2] == k for x in base))
                hashes.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(hashes, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def secret_scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, counts and hash of the base finds, and all spans, for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scanned(reach), OUTPUT)
