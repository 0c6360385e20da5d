import random
import re
import string
from itertools import combinations

import numpy as np
import pytest

from devdelta.llm import jaccard_join as J
from devdelta.llm.components import connected
from tests.llm.helpers import awkward, documents, none, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def expected(texts, percent, size):
    sets = [shingles(t, size) for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = sorted((top(i), top(j)))
            up[b] = a
    return {i: (len(s), top(i)) for i, s in enumerate(sets)}


def near_copies(rng):
    texts = []
    for n in (1, 2, 3, 4, 5, 6, 9, 12, 20, 40, 90, 300):
        base = words(rng, n, 10_000).split()
        texts += [" ".join(base)] * 2
        for edits in (1, 1, 2, 3, 5, 9):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
            texts.append(" ".join(w))
            texts.append(" ".join(base + w[:edits]).upper())
    return texts + [words(rng, rng.randrange(2, 60), 6) for _ in range(60)] + ["", None, " \t", "one"]


@pytest.mark.parametrize("percent,size", [(85, 4), (80, 5)])
def test_components_equal_brute_force(spark, percent, size):
    texts = near_copies(random.Random(percent))
    got = J.similar_components(documents(spark, texts), percent, size).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected(texts, percent, size)
    parts = {r["component_id"] for r in got}
    assert sum(r["kept"] for r in got) == len(parts)


def test_other_texts(spark):
    texts = near_copies(random.Random(5))
    got = J.similar_components(documents(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected(texts, 85, 4)


def test_linked_sets_share_a_word_and_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    bands = J.Bands(85)
    for n in [*range(2, 60), 100, 300, 1000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            most = bands.difference(2 * n)
            gone = int(rng.integers(0, most + 1))
            b = np.unique(np.concatenate((a[gone:], rng.integers(0, 2**63, int(rng.integers(0, max(1, most - gone + 1))), dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            if 100 * both < 85 * (len(a) + len(b) - both):
                continue
            x = {int(k) for band in bands.of(len(a)) for k in J.sketch_words(a, band, 0)[0]}
            y = {int(k) for band in bands.of(len(b)) for k in J.sketch_words(b, band, 0)[0]}
            assert x & y or np.array_equal(a, b)
            assert J.sketch_distance(J.bit_sketch(a), J.bit_sketch(b)) <= len(a) + len(b) - 2 * both


def test_awkward_rows(spark):
    df = awkward(spark)
    got = J.similar_components(df).collect()
    assert len(got) == df.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by[0] == [(0, 0)] and by[1] == [(0, 1)] and by[2] == [(0, 2)]
    assert by[4] == [(1, 3)] and by[6][0][1] == 5 and by[7][0][1] == 5
    assert by[8] == [(57, 8)] * 3 and sorted(by[None], key=str) == [(0, None), (1, 3)]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(100)] + [(200, 201)], "a long, b long")
    got = {r["node"]: r["label"] for r in connected(links).collect()}
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}


def test_empty_table(spark):
    assert J.similar_components(none(spark)).collect() == []


def test_near_copies_beyond_the_threshold_form_few_pairs(spark, monkeypatch):
    """A thousand texts that vary one text, each too far from it and from the others to link."""
    rng = random.Random(21)
    base = [f"w{i}" for i in range(160)]
    texts = []
    for i in range(1000):
        words = list(base)
        for k in rng.sample(range(160), 14):
            words[k] = f"x{i}y{k}"
        texts.append(" ".join(words))
    made = []
    across = J.Join.across

    def counted(listed):
        pairs = across(listed)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(J.Join, "across", staticmethod(counted))
    rows = J.similar_components(documents(spark, texts)).collect()
    assert len(rows) == 1000 and all(r["component_id"] == r["doc_id"] for r in rows)
    assert made and sum(made) < 3 * 1000
