import random
import re
from collections import Counter, defaultdict

from devdelta.llm import quality_rules as Q
from tests.llm.helpers import DOCS_DDL, awkward, documents, none, words


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    marked = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), len(lines)


def test_counts_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "cé", " ", " ", "\n", "\t", "#", "|", "\xa0", "\x0b"]) for _ in range(rng.randrange(120)))
        assert Q.text_counts(text) == counts(text)
    assert Q.text_counts(None) == Q.text_counts("") == (0,) * 6


def test_base_failures_and_thresholds(spark):
    rng = random.Random(6)
    clean = [words(rng, rng.randrange(60, 200), 5000) for _ in range(300)]
    bad = ["x " * 200, "### ".join(words(rng, 100, 5000).split()), "few words", "\n".join(["same line of words here"] * 30)]
    df = documents(spark, clean + bad)
    got = {r["doc_id"]: r for r in Q.quality_rules(df).collect()}
    for i, t in enumerate(clean + bad):
        r, (n, chars, symbols, lines, repeated, _) = got[i], counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
    assert all(got[i]["kept"] for i in range(300)) and not any(got[300 + i]["kept"] for i in range(4))


def test_sketch_quantiles_are_near_the_exact_ones(spark):
    rng = random.Random(7)
    rows = [("en", "s", rng.random(), *[0.0] * 4, False) for _ in range(5000)]
    ddl = "lang string, source string, " + ", ".join(f"{m} double" for m in Q.MEASURES) + ", base_failed boolean"
    limit = Q.thresholds(spark.createDataFrame(rows, ddl), fence=1.0).first()["repeat_share_limit"]
    values = sorted(r[2] for r in rows)
    assert abs(limit - (values[3750] + values[3750] - values[1250])) < 0.05


def test_the_groups_quantiles_set_the_limits(spark):
    rng = random.Random(8)
    spell = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    text = lambda low, high: " ".join(spell(rng.randrange(low, high)) for _ in range(100))
    marked = text(3, 8) + " #" * 20  # 1 symbol in 6 words
    twice = " ".join([text(3, 8), *["some three words"] * 22])  # 2 words in 5 stand in repeats
    lines = "\n".join([text(3, 8) for _ in range(31)] + [spell(9)] * 20)  # 19 lines of 51
    rows = [(text(3, 8), "en", "short") for _ in range(60)] + [(text(8, 13), "de", "long") for _ in range(60)]
    # beyond what most of their groups hold, below 12 characters a word, 0.30 symbols a word, 0.45 repeats, 0.40 lines, above 2.5 characters
    bad = [(text(8, 13), "en", "short"), (text(3, 8), "de", "long"), (marked, "en", "short"), (twice, "en", "short"), (lines, "en", "short")]
    # alone in its source: judged by its language
    bad += [(text(20, 25), "en", "alone")]
    good = [(text(4, 8), "en", "alone too")]
    table = spark.createDataFrame([(i, *r, len(r[0])) for i, r in enumerate(rows + bad + good)], DOCS_DDL)
    got = {r["doc_id"]: r for r in Q.quality_rules(table).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [i for i, r in sorted(got.items()) if not r["kept"]] == list(range(120, 126))


def test_awkward_and_empty(spark):
    df = awkward(spark)
    got = defaultdict(list)
    for r in Q.quality_rules(df).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == df.count()
    assert got[0][0]["base_failed"] and not got[1][0]["kept"] and len(got[8]) == 3
    assert Q.quality_rules(none(spark)).collect() == []


def test_small_groups_lean_on_their_language_without_a_jump(spark):
    ddl = "lang string, source string, " + ", ".join(f"{m} double" for m in Q.MEASURES) + ", base_failed boolean"
    sizes = [1, 29, 30, 31, 100, 400]
    rows = [("en", f"s{n}", *[0.6 + 0.2 * (i % 2)] * 5, False) for n in sizes for i in range(n)]
    rows += [("en", "other", *[0.1 + 0.1 * (i % 2)] * 5, False) for i in range(4000)]
    got = {r["source"]: r["repeat_share_limit"] for r in Q.thresholds(spark.createDataFrame(rows, ddl), fence=0.0).collect()}
    limits = [got[f"s{n}"] for n in sizes]
    assert all(abs(x - (n * 0.8 + Q.SHRINK * 0.2) / (n + Q.SHRINK)) < 0.01 for n, x in zip(sizes[1:], limits[1:]))
    assert limits == sorted(limits) and limits[2] - limits[1] < 0.01


def test_groups_without_any_symbols_have_limits_of_their_own(spark):
    rng = random.Random(9)
    rows = [(words(rng, rng.randrange(60, 200), 5000), "en", "short") for _ in range(150)]
    rows += [(words(rng, rng.randrange(600, 2000), 5000), "en", "long") for _ in range(150)]
    df = spark.createDataFrame([(i, *r, len(r[0])) for i, r in enumerate(rows)], DOCS_DDL)
    measured = Q.document_counts(df).withColumn("base_failed", Q.base_failed()).selectExpr("*", *[f"{e} AS {m}" for m, (e, *_) in Q.MEASURES.items()])
    got = {r["source"]: r["symbol_share_limit"] for r in Q.thresholds(measured).collect()}
    assert got["short"] > 1.2 * got["long"]
    assert all(r["kept"] for r in Q.quality_rules(df).collect())
