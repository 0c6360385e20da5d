"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard of bytes."""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S); the end of the string is smaller than all."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int32) - s[:-1])
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n - 1)
    decides = np.minimum.accumulate(at[::-1])[::-1]
    return step[decides] > 0


def _deal(p: np.ndarray, chars: np.ndarray, parts: list[list[np.ndarray]]) -> None:
    """Append positions to the buckets of their characters, in the order given."""
    order = np.argsort(chars, kind="stable")
    p, chars = p[order], chars[order]
    cut = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    for c, part in zip(chars[np.concatenate(([0], cut))].tolist(), np.split(p, cut)):
        parts[c].append(part)


def _chain(first: np.ndarray, s: np.ndarray, of_type: np.ndarray, c: int) -> np.ndarray:
    """A bucket's entries and those of the same bucket that follow from them."""
    full = [first]
    while len(first):
        p = first[first > 0] - 1
        first = p[of_type[p] & (s[p] == c)]
        full.append(first)
    return np.concatenate(full)


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in order, from the order of the leftmost-smaller ones; a bucket at a time."""
    n, none = len(s), np.zeros(0, np.int64)
    large = ~small
    order = np.argsort(s[lms], kind="stable")
    seeds = lms[order]
    edge = np.searchsorted(s[seeds], np.arange(k + 1))
    parts: list[list[np.ndarray]] = [[] for _ in range(k)]
    parts[int(s[-1])].append(np.array([n - 1]))
    larges: list[np.ndarray] = [none] * k
    for c in range(k):
        mine = _chain(np.concatenate(parts[c]), s, large, c) if parts[c] else none
        larges[c] = mine
        scan = np.concatenate((mine, seeds[edge[c] : edge[c + 1]]))
        p = scan[scan > 0] - 1
        p = p[large[p] & (s[p] > c)]
        if len(p):
            _deal(p, s[p], parts)
    parts = [[] for _ in range(k)]
    out: list[np.ndarray] = [none] * k
    for c in range(k - 1, -1, -1):
        mine = _chain(np.concatenate(parts[c]), s, small, c) if parts[c] else none
        out[c] = np.concatenate((larges[c], mine[::-1]))
        scan = out[c][::-1]
        p = scan[scan > 0] - 1
        p = p[small[p] & (s[p] < c)]
        if len(p):
            _deal(p, s[p], parts)
    return np.concatenate(out)


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Equal leftmost-smaller substrings get equal names, greater ones greater names; in text order."""
    n = len(s)
    length = np.zeros(n, np.int64)
    length[lms] = np.diff(np.concatenate((lms, [n]))) + 1
    a, b = ordered[:-1], ordered[1:]
    same = (length[a] == length[b]) & (a != lms[-1]) & (b != lms[-1])
    active = np.flatnonzero(same)
    t = 0
    while len(active):
        x, y = a[active], b[active]
        equal = s[x + t] == s[y + t]
        same[active[~equal]] = False
        t += 1
        active = active[equal & (t < length[x])]
    names = np.zeros(n, np.int64)
    names[ordered] = np.concatenate(([0], np.cumsum(~same)))
    return names[lms]


def _order_of_names(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string of names.

    Recursive: the ranks of the pieces of ``width`` names name the pieces of
    twice that width, which only those not yet told apart need.
    """
    n = len(names)
    count = np.bincount(names)
    first = np.cumsum(count) - count
    rank = first[names]
    open_ = np.flatnonzero(count[names] > 1)
    width = 1
    while len(open_):
        after = open_ + width
        second = np.zeros(len(open_), np.int64)  # the end is smaller than all names
        inside = after < n
        second[inside] = rank[after[inside]] + 1
        pair = rank[open_] * (n + 1) + second
        by = np.argsort(pair)
        open_, pair = open_[by], pair[by]
        old = rank[open_]
        begins = np.concatenate(([True], pair[1:] != pair[:-1]))
        group = np.concatenate(([True], old[1:] != old[:-1]))
        at = np.arange(len(open_))
        begin = np.maximum.accumulate(np.where(begins, at, 0))
        rank[open_] = old + begin - np.maximum.accumulate(np.where(group, at, 0))
        open_ = open_[~(begins & np.concatenate((begins[1:], [True])))]
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """The order of the suffixes of ``s`` (values 0 to k - 1)."""
    if not len(s):
        return np.zeros(0, np.int64)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        is_lms = np.zeros(len(s), bool)
        is_lms[lms] = True
        rough = _induce(s, small, lms, k)
        lms = lms[_order_of_names(_names(s, lms, rough[is_lms[rough]]))]
    return _induce(s, small, lms, k)


def permuted_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position the length of the prefix its suffix shares with the suffix before it in order.

    Where the characters before two such suffixes are equal, the value is one
    less than that of the position before; only the others are compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    own = (before < 0) | (before == 0) | (at == 0)
    rest = np.flatnonzero(~own)
    own[rest] = s[rest - 1] != s[before[rest] - 1]
    start = np.flatnonzero(own)
    value = np.zeros(n, np.int64)
    active = start[before[start] >= 0]
    shared = np.zeros(n, np.int64)
    # four characters at a time (a value past the end differs from all), then one by one
    wide = np.zeros(n + 4, np.uint64)
    wide[:n] = s.astype(np.uint64) + np.uint64(1)
    wide = wide[:n] | wide[1 : n + 1] << np.uint64(16) | wide[2 : n + 2] << np.uint64(32) | wide[3 : n + 3] << np.uint64(48)
    left = active
    while len(left):
        x, y = left + shared[left], before[left] + shared[left]
        inside = (x < n - 3) & (y < n - 3)
        left, x, y = left[inside], x[inside], y[inside]
        left = left[wide[x] == wide[y]]
        shared[left] += 4
    while len(active):
        x, y = active + shared[active], before[active] + shared[active]
        inside = (x < n) & (y < n)
        active, x, y = active[inside], x[inside], y[inside]
        active = active[s[x] == s[y]]
        shared[active] += 1
    source = start[np.cumsum(own) - 1]
    value = shared[source] - (at - source)
    return np.maximum(value, 0)
