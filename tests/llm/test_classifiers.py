import random
import re
import zlib

import numpy as np

from devdelta.llm import quality_qda as Q
from devdelta.llm import toxicity as T
from tests.llm.helpers import DOCS_DDL, awkward, documents, none

LABELS_DDL = "doc_id long, quality int, toxic int, text string, source string"


def table(spark, seed=1, n=600):
    """Texts of random words; toxic ones hold a few words of a bad stem, low-quality ones repeat or shout."""
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghiklmnoprst") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 150))]
        toxic, quality = rng.random() < 0.25, rng.random() < 0.7
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = "zuvw" + rng.choice(["er", "el", "ok", "umi", "aba"])
        if not quality:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w for w in words for _ in range(5)]
        texts.append(" ".join(words) + ".")
        labels.append((i, int(quality), int(toxic), "clash", "clash"))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS_DDL), labels


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def accuracy(rows, labels, column, low):
    truth = {r[0]: r[column] for r in labels}
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= low) and 0 <= r["score"] <= 1 for r in rows)
    test = [r for r in rows if r["held_out"]]
    return sum(r["predicted"] == truth[r["doc_id"]] for r in test) / len(test)


def test_quality_on_held_out_rows(spark):
    docs, labels, truth = table(spark)
    assert accuracy(Q.quality_scores(docs, labels).collect(), truth, 1, 0.7) > 0.95


def test_toxicity_on_held_out_rows_and_unseen_misspellings(spark):
    docs, labels, truth = table(spark)
    model = T.fitted(docs, labels)
    assert accuracy(T.toxicity_scores(docs, labels).collect(), truth, 2, 0.3) > 0.95
    new = documents(spark, ["plain words stand here", "plain words zuvwakk zuvwix here"])
    a, b = (r["score"] for r in T.score_texts(new, model).orderBy("doc_id").collect())
    assert a < 0.3 < b
    assert [r["doc_id"] for r in T.without_toxic(new, model).collect()] == [0]


def test_held_out_labels_are_never_learnt(spark):
    docs, labels, truth = table(spark, n=300)
    flipped = [(d, 1 - q, 1 - t, x, s) if held_out(d) else (d, q, t, x, s) for d, q, t, x, s in truth]
    other = spark.createDataFrame(flipped, LABELS_DDL)
    for score in (Q.quality_scores, T.toxicity_scores):
        a, b = ({r["doc_id"]: r["score"] for r in score(docs, x).collect()} for x in (labels, other))
        assert a == b


def test_batches_do_not_change_vectors_and_values():
    texts = [None, "", "One two, two TWO!! x1.", "a " * 100, "é　日本 \U0001f600", "line\nline\nline"]
    together = Q.text_vectors(texts)
    assert np.allclose(together, np.concatenate([Q.text_vectors([t]) for t in texts]))
    ids, size, per = T.bags(texts)
    parts = [T.bags([t]) for t in texts]
    assert np.array_equal(ids, np.concatenate([p[0] for p in parts])) and np.array_equal(size, np.concatenate([p[1] for p in parts]))
    assert per.tolist() == [p[2][0] for p in parts] == [0, 0, 5, 100, 3, 3]


def test_awkward_rows_and_missing_labels(spark):
    df = awkward(spark)
    _, labels, _ = table(spark, n=40)
    empty = labels.limit(0)
    one_class = labels.where("quality = 1 and toxic = 0")
    nulls = spark.createDataFrame([(None, 1, 1, "", ""), (5, None, None, "", "")], LABELS_DDL)
    for score in (Q.quality_scores, T.toxicity_scores):
        for known in (labels, empty, one_class, nulls):
            rows = score(df, known).collect()
            assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert score(none(spark), labels).collect() == []
    assert DOCS_DDL


def naive_bags(text):
    """Rows of each word's grams, one character at a time."""
    clean = "".join(c if c.isalnum() else " " for c in (text or "").lower())
    out = []
    for m in re.finditer(r"[^ ]+", clean):
        codes = [0, *map(ord, m[0]), 0]
        rows = []
        for at in range(len(codes)):
            for n in (3, 4, 5):
                gram = codes[at : at + n]
                if len(gram) == n:
                    h = gram[0]
                    for c in gram[1:]:
                        h = (h * 0x01000193 + c) % 2**32
                    h ^= h >> 15
                    h = h * (0x2C1B3C6D + 2 * (n - 1)) % 2**32
                    rows.append((h ^ h >> 13) % T.BUCKETS)
        out.append(rows)
    return out


def test_bags_and_word_values_equal_a_naive_version():
    rng = np.random.default_rng(3)
    weight = rng.normal(size=T.BUCKETS).astype(np.float32)
    for text in ["One two, two TWO!! x1.", "a ab abc", "é　日本 ñandú", "", "...", "fünf" * 30]:
        ids, size, per = T.bags([text])
        naive = naive_bags(text)
        values = T.word_values(weight, ids, size)
        assert per.tolist() == [len(naive)] and len(values) == len(naive)
        upto = np.concatenate(([0], np.cumsum(size)))
        for k, rows in enumerate(naive):
            assert sorted(ids[upto[k] : upto[k + 1]].tolist()) == sorted(rows)
            assert abs(values[k] - np.mean(weight[rows], dtype=np.float64)) < 1e-6


def test_a_stronger_logit_never_counts_for_less():
    x = np.array([0.0, 1.0, 2.0, 3.0])
    slope, _ = T._logistic(x, np.array([1, 1, 0, 0]), np.full(4, 0.25))
    assert slope > 0


def test_few_texts_are_trained_in_enough_steps():
    """A sample of three hundred texts, thirty of them toxic, is told apart on other texts."""
    rng = random.Random(9)

    def text(toxic):
        words = ["".join(rng.choice("abcdefghiklmnoprst") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
        for _ in range(2 * toxic):
            words[rng.randrange(60)] = "zuvw" + rng.choice(["er", "el", "ok"])
        return " ".join(words)

    labels = [int(i % 10 == 0) for i in range(300)]
    model = T.fit([text(y) for y in labels], labels, (0.9, 0.1))
    scores = model.probability(T._logits(model, [text(1) for _ in range(50)] + [text(0) for _ in range(200)]))
    assert model.slope > 0 and (scores[:50] >= 0.3).mean() > 0.8 and (scores[50:] >= 0.3).mean() < 0.05


def plain_statistics(text):
    """The 19 statistics, word by word."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(Q.NAMES)
    flags = []
    for i, w in enumerate(words):
        letters = [c for c in w if c.isalpha()]
        odd = any(not (c.isalnum() or c in ".,;:!?'\"()-") for c in w)
        shout = len(letters) > 1 and all(c.isupper() for c in letters)
        flags.append([shout, odd, w[-1] == "!", i > 0 and words[i - 1] == w, not letters, any(c.isdigit() for c in w), w[-1] in ".!?"])
    flags = np.array(flags, float)
    mean = flags.mean(0)
    worst = np.max([flags[i : i + 12].mean(0) for i in range(max(1, n - 11))], 0)
    grams = [tuple(words[i : i + 3]) for i in range(n - 2)]
    again = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    blocks = [words[i : i + 50] for i in range(0, n, 50)]
    ratios = [len(set(b)) / len(b) for b in blocks]
    stops = [-1, *np.flatnonzero(flags[:, 6]).tolist(), n]
    lines = [x for x in text.split("\n") if x.strip()]
    roots = {
        "upper": mean[0], "symbols": mean[1], "bang": mean[2], "digits": mean[5], "again": mean[3], "repeated": len(again) / n,
        "duplicate_lines": 1 - len(set(lines)) / len(lines), "no_letter": mean[4], "worst_upper": worst[0], "worst_symbols": worst[1],
        "worst_bang": worst[2], "worst_again": worst[3], "worst_no_letter": worst[4], "stops": mean[6],
    }
    out = {k: v**0.5 for k, v in roots.items()}
    out["log_words"], out["word_length"] = np.log1p(n), np.log1p(sum(map(len, words)) / n)
    out["longest_run"] = np.log1p(max(b - a for a, b in zip(stops, stops[1:])))
    out["distinct"] = np.mean(ratios)
    out["worst_distinct"] = min(r for r, b in zip(ratios, blocks) if len(b) >= min(n, 25))
    return [out[k] for k in Q.NAMES]


def test_statistics_equal_brute_force():
    rng = random.Random(11)
    pool = ["one", "TWO", "tWo!", "x1.", "***", "a?", "É", "日本", "12", "no-break\xa0x", "I", "end.\n", "same line\n"]
    texts = [None, "", " \n", "w " * 130]
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randrange(1, 200))) for _ in range(120)]
    assert np.allclose(Q.text_vectors(texts), [plain_statistics(t) for t in texts])


def test_log_densities_equal_the_formula():
    rng = np.random.default_rng(4)
    d, by = len(Q.NAMES), {}
    x = {k: rng.normal(k, 1 + k, (80 + 40 * k, d)) @ rng.normal(0, 1, (d, d)) for k in (0, 1)}
    for k in (0, 1):
        one = np.column_stack((np.ones(len(x[k])), x[k]))
        by[k] = one.T @ one
    model = Q.discriminant(by)
    centred = {k: x[k] - x[k].mean(0) for k in x}
    pooled = sum(c.T @ c for c in centred.values()) / 200
    pooled = 0.9 * pooled + 0.1 * np.diag(np.diag(pooled))
    new, density = rng.normal(0, 2, (50, d)), []
    for k in (0, 1):
        cov = 0.95 * centred[k].T @ centred[k] / len(x[k]) + 0.05 * pooled + np.diag(1e-4 + 0.01 * np.diag(pooled))
        z = new - x[k].mean(0)
        density.append(-0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) + np.linalg.slogdet(cov)[1]))
    raw = density[1] - density[0] + np.log(len(x[1]) / len(x[0]))
    assert np.allclose(model.difference(new), np.sign(raw) * np.log1p(np.abs(raw)), rtol=1e-6)
