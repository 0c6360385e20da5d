import hashlib
import random
import string
from collections import defaultdict

import pytest

from devdelta.llm import exact_dedup
from devdelta.llm.common import ROW_ID
from tests.llm.helpers import awkward, documents, none, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(LOWER)].append(doc)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        out += [(i, best, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def result(df, block):
    out = exact_dedup.exact_groups(df, block).collect()
    return out, sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out), key=str)


@pytest.mark.parametrize("block", [7, 16 * 1024])
def test_groups_equal_brute_force(spark, block):
    rng = random.Random(1)
    texts = [words(rng, rng.randrange(12), 3) for _ in range(60)] + ["İstanbul", "i̇stanbul", "ABC", "abc", "É", "é"]
    df = documents(spark, texts)
    assert result(df, block)[1] == expected(enumerate(texts))


def test_awkward_rows_keep_one_of_each_group(spark):
    df = awkward(spark)
    rows, got = result(df, 4096)
    assert got == expected([(r["doc_id"], r["text"]) for r in df.collect()])
    assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})


def test_blocks_with_one_hash_are_told_apart(spark, monkeypatch):
    blocks = {b"aaaa": 1, b"bbbb": 1}
    monkeypatch.setattr(exact_dedup, "_hash", lambda b: blocks.get(b, len(b)))
    out = exact_dedup._blocks("aaaabbbb", 4)
    assert [exact_dedup._hash(b) for b in out] == [1, 1]


def test_collisions_are_named_by_bytes(spark):
    members = spark.createDataFrame([((0, 0), 0, 1, 0, 5, "s0"), ((0, 1), 1, 1, 0, 5, "s1"), ((0, 2), 2, 1, 0, 5, "s0")], f"uid {ROW_ID}, doc_id long, n int, pos int, h long, sha string")

    class Fixed:
        pass

    original = exact_dedup._contents

    def contents(size, with_uid):
        def run(batches):
            import pyarrow as pa

            for b in original(size, with_uid)(batches):
                h = pa.array([5] * b.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([h if n == "h" else b[n] for n in b.schema.names], b.schema.names)

        return run

    rows = spark.createDataFrame([((0, 0), "one"), ((0, 1), "two"), ((0, 2), "ONE")], f"uid {ROW_ID}, text string").coalesce(1)
    exact_dedup._contents = contents
    try:
        got = {r["uid"]["r"]: r["name"] for r in exact_dedup._first_names(rows, members, 16).collect()}
    finally:
        exact_dedup._contents = original
    assert got[0] == got[2] != got[1]


def test_empty_table(spark):
    assert exact_dedup.exact_groups(none(spark)).collect() == []
