import random
import re
import string
import time

from devdelta.llm import license_scan as L
from tests.llm.helpers import awkward, documents, none

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = [
        (i, label)
        for phrase, label in L.BASE_PHRASES.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_base_columns_equal_brute_force(spark):
    rng = random.Random(9)
    parts = ["Under the MIT License", "under", "the", "mit", "license", "Apache License, Version 2", "cc-BY/nc", "by", "nc", "é", "x1", ".", "\n", "İ"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(200)]
    got = {r["doc_id"]: r for r in L.license_scan(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


def edited(rng, text, k):
    for _ in range(k):
        i = rng.randrange(len(text))
        kind = rng.randrange(3)
        text = text[:i] + ("" if kind == 0 else rng.choice("abcxyz")) + text[i + (kind != 1) :]
    return text


def test_every_notice_is_found_with_its_edits():
    rng = random.Random(10)
    notices = tuple(L.NOTICES.items())
    for notice, label in notices:
        for _ in range(30):
            k = rng.randrange(L.max_edits(notice) + 1)
            text = "some words before " + edited(rng, notice, k) + " and after"
            found = [m for m in L.fuzzy_matches(text, notices) if m[0] == label]
            assert found and min(m[3] for m in found) <= k, (notice, text)
    assert L.fuzzy_matches("no notice stands in this text at all but rights", notices) == []


def test_every_notice_of_a_row_of_notices_is_found():
    rng = random.Random(11)
    for notice, label in L.NOTICES.items():
        notices = ((notice, label),)
        worse = notice[:7] + notice[8:]
        for text in (f"{worse} {notice}", f"{notice} {worse}", f"{worse} {notice} {worse}"):
            found = L.fuzzy_matches(text, notices)
            assert sorted(m[3] for m in found) == [0, *[1] * (len(found) - 1)] and len(found) == 1 + text.count(worse), text
        for _ in range(10):
            k = L.max_edits(notice)
            # edits inside the copies, so that each copy's place is certain
            copies = [notice[0] + edited(rng, notice[1:-1], rng.randrange(k + 1)) + notice[-1] for _ in range(8)]
            found = L.fuzzy_matches(" ".join(copies), notices)
            at = 0
            for copy in copies:
                assert any(m[1] < at + len(copy) and m[2] > at for m in found), copies
                at += len(copy) + 1
            assert len(found) == len(copies) and all(a[2] <= b[1] for a, b in zip(found, found[1:])), copies


def test_spans_are_words(spark):
    df = documents(spark, ["one two All rights reservd end", "All rights reserved"])
    a, b = sorted(L.license_scan(df).collect(), key=lambda r: r["doc_id"])
    assert [(s["label"], s["first_word"], s["edits"]) for s in a["spans"]] == [("proprietary", 2, 1)]
    assert a["labels"] == b["labels"] == "proprietary" and b["score"] == 1.0 > a["score"]


def test_awkward_and_empty(spark):
    df = awkward(spark)
    got = L.license_scan(df).collect()
    assert len(got) == df.count()
    assert all(r["n_words"] == 0 and r["labels"] == "" and r["score"] == 0 for r in got if r["doc_id"] in (0, 1, 2))
    assert L.license_scan(none(spark)).collect() == []


def test_matches_stand_between_words():
    notices = tuple(L.NOTICES.items())
    for text in ("small rights reserved", "overall rights reserveds", "unreleased under the mit licensees"):
        assert not [m for m in L.fuzzy_matches(text, notices) if m[3] == 0], text
    assert [m[1:4] for m in L.fuzzy_matches("all rights reserved", notices)] == [(0, 19, 0)]
    assert [m[1:4] for m in L.fuzzy_matches("x all rights reservd y", notices)] == [(2, 20, 1)]


def test_long_texts_are_linear():
    def seconds(phrase, n):
        start = time.perf_counter()
        row = L.scan_text(phrase * n, tuple(L.BASE_PHRASES.items()), tuple(L.NOTICES.items()))
        return time.perf_counter() - start, row

    phrase = "under the mit license "
    seconds(phrase, 100)
    small, _ = seconds(phrase, 10_000)
    large, row = seconds(phrase, 40_000)  # 880 KB
    assert row[1] == 40_000 and row[3] == 4 * 39_999 and large < 7 * max(small, 0.05)
    spans = seconds("all rights reserved ", 20_000)[1][7]
    assert len(spans) == 20_000 and spans[-1]["first_word"] == 59_997 and spans[-1]["last_word"] == 59_999
