import hashlib
import math
import random
import re
import zlib

import pytest

from devdelta.llm import resampling as R
from tests.llm.helpers import awkward, documents, none, words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def runs(text):
    w = WORD.findall(low(text or ""))
    return [[zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for i in range(len(w) - n + 1)] for n in (1, 2, 3)], len(w)


def brute(rows, target, percent=5, least=20):
    """(doc_id, n_features, weight, score) of all, and the drawn (score, id) in order."""
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f in runs(x)[0]:
                for b in f:
                    counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    out = []
    for i, x in rows:
        f, n = runs(x)
        weight = sum(gain[b] for r in f for b in r)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, sum(map(len, f)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((-r[3], r[0] is None, r[0] or 0) for r in out if r[4] >= least)
    return [r[:4] for r in out], [(-a, None if no else b) for a, no, b in able[: percent * len(able) // 100]]


def check(spark, docs, rows, target, **more):
    got = R.resample(docs, spark.createDataFrame([(x,) for x in target], "text string"), **more).collect()
    every, drawn = brute(rows, target, **{k: v for k, v in more.items() if k == "percent"})
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=key) == sorted(every, key=key)
    ranked = sorted((r["rank"], r["score"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranked] == drawn


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_equals_brute_force(spark, percent):
    rng = random.Random(4)
    texts = [words(rng, rng.randrange(0, 120), 400) for _ in range(400)]
    docs = documents(spark, texts).repartition(5)
    target = [words(rng, 60, 90) for _ in range(20)]
    check(spark, docs, list(enumerate(texts)), target, percent=percent)


def test_words_of_all_kinds():
    texts = [None, "", "A b-C_d", "é ÀB x-y 1 2", "q" * 70 + " b " + "z" * 300 + " c", "日本 \x7f x`y{z}|~\x80", "... !!", " lead  trail "]
    found, where, n = R.features(texts)
    for i, t in enumerate(texts):
        expected, count = runs(t)
        assert n[i] == count and [f[w == i].tolist() for f, w in zip(found, where)] == expected
    assert R.features([])[2].tolist() == []


def test_copies_and_equal_scores(spark):
    """Many equal texts, some with one id: ties go by id, then place; nothing is lost or drawn twice."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i % 150, text) for i in range(450)] + [(1000 + i, text + f" x{i}") for i in range(50)]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(6)
    check(spark, docs, rows, [text], percent=30)


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    scores = spark.range(5000).selectExpr("id % 700 as score")
    every = sorted((r["score"] for r in scores.collect()), reverse=True)
    for k in (1, 2, 250, 2500, 4999, 5000):
        for start in (1e-9, 0.004):
            lowest, highest, above = R.bracket(scores, k, 5000, start)
            assert lowest <= every[k - 1] <= highest and above == sum(x > highest for x in every) < k
    narrow = R.bracket(scores, 250, 5000)
    assert sum(narrow[0] <= x <= narrow[1] for x in every) < 300


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    check(spark, df, rows, ["w1 w2 w3", None, ""], percent=50)
    check(spark, df, rows, [], percent=50)
    target = spark.createDataFrame([("a b",)], "text string")
    assert R.resample(none(spark), target).collect() == []
    assert all(r["rank"] is None for r in R.resample(documents(spark, ["a b", None]), target).collect())
