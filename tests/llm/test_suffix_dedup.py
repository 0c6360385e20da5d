import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from devdelta.llm import suffix_dedup as S
from devdelta.llm.suffix_array import _order_of_names, permuted_prefixes, suffix_array
from tests.llm.helpers import awkward, documents, none, words


def expected(rows, size):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + size] for _, b in data for i in range(len(b) - size + 1))
    out = []
    for d, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, size, **options):
    return sorted((tuple(r) for r in S.remove_repeats(df, size, **options).collect()), key=str)


def texts(rng):
    passage = words(rng, 30)
    out = [words(rng, rng.randrange(40)) for _ in range(20)]
    out += [f"{words(rng, rng.randrange(9))} {passage} {words(rng, rng.randrange(9))}" for _ in range(12)]
    out += ["ab" * 60, "a" * 90, "abc" * 7, passage, passage, passage[3:80], passage.upper(), "", None, "éè" * 30]
    return out


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 100}, {"stretch": 40, "batch": 50}])
def test_removed_bytes_equal_brute_force(spark, options):
    t = texts(random.Random(8))
    assert result(documents(spark, t), 24, gram=8, **options) == expected(enumerate(t), 24)


def test_a_line_in_all_texts_is_dealt_again(spark, monkeypatch):
    rng = random.Random(12)
    line = words(rng, 6)
    t = [f"{words(rng, 8)} {line} {words(rng, 8)}" for _ in range(60)]
    t += [x[5:] for x in t[:20]] + t[:3]  # windows around the line that come again
    levels = []
    plain = S.text_runs
    monkeypatch.setattr(S, "text_runs", lambda rows, size, gram, stretch, level: levels.append(level) or plain(rows, size, gram, stretch, level))
    assert result(documents(spark, t), 48, gram=8, shard_bytes=2000) == expected(enumerate(t), 48)
    assert levels[:2] == [0, 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 4))
def test_suffix_array_and_prefixes(s, times):
    s = s * times
    want = sorted(range(len(s)), key=lambda i: s[i:])
    a = np.array(s, np.int16)
    assert suffix_array(a, 4).tolist() == want == _order_of_names(np.array(s)).tolist()
    got = permuted_prefixes(a, np.array(want))
    for x, y in zip(want, want[1:]):
        n = 0
        while max(x, y) + n < len(s) and s[x + n] == s[y + n]:
            n += 1
        assert got[y] == n


def test_awkward_rows(spark):
    df = awkward(spark)
    got = S.remove_repeats(df).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(got) == df.count()
    assert by[0][0]["n_bytes"] == 0 and by[0][0]["n_removed"] == 0
    long = by[5][0]  # its copy without the last five bytes covers the rest
    assert long["n_removed"] == long["n_bytes"] - 5 and by[7][0]["n_removed"] == by[7][0]["n_bytes"]
    assert by[6][0]["n_removed"] == 0  # upper case


def test_empty_table(spark):
    assert S.remove_repeats(none(spark)).collect() == []
