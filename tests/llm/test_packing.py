import random
import struct
import zlib
from collections import Counter, defaultdict

from devdelta.llm import packing as P
from tests.llm.helpers import awkward, documents, none, words

ODD = ["", "a\x1cb c", "Don't STOP.it's o'clock 'S", "naïve É É. ﬁ", "<|endoftext|> x<|startoftext|>y", "123 45,6 $%&", "ΣΑΣ. İstanbul"]
ODD += ["x　y z\x85w", "fin. Fin! FIN?? éa. ÉA.", "日本語。テスト áb.", "don'.t'", "'re 're.", "a.'s", "é .́"]


def test_ids_equal_the_tokenizer():
    ids = P.Ids(P.default_tokenizer())
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("abÉ é.,'! 1\ń") for _ in range(80)) for _ in range(200)]
    for t, got in zip(texts, ids.of(texts)):
        want = ids.tokenizer.encode(t, add_special_tokens=False).ids
        assert got == struct.pack(f"<{len(want)}I", *want), t


def check(texts, rows, size):
    ids = P.Ids(P.default_tokenizer())
    streams = defaultdict(Counter)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc, t in texts:
        data = ids.of([t])[0] + struct.pack("<I", 1)
        streams[doc][data] += 1
    for doc, data in streams.items():
        want = Counter()
        for d, times in data.items():
            n = len(d) // 4
            for s in range(0, n, size):
                part = d[4 * s : 4 * min(n, s + size)]
                want[(s, len(part) // 4, zlib.crc32(part), n)] += times
        assert Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[doc]) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(5)
    texts = ODD + [words(rng, rng.randrange(120)) for _ in range(150)]
    rows = P.pack(documents(spark, texts), size=64, group_rows=100).collect()
    sequences = check(list(enumerate(texts)), rows, 64)
    used = sum(n for s in sequences.values() for _, n in s)
    assert sum(64 - sum(n for _, n in s) for s in sequences.values()) < 0.05 * used


def test_patterns_place_the_whole_histogram():
    rng = random.Random(6)
    for _ in range(50):
        histogram = {n: rng.randrange(1, 1000) for n in rng.sample(range(1, 65), rng.randrange(1, 40))}
        placed = Counter()
        for count, pattern in P.shortest_pack_first(histogram, 64):
            assert sum(pattern) <= 64 and count > 0
            for n in pattern:
                placed[n] += count
        assert placed == histogram


def test_awkward_and_empty(spark):
    df = awkward(spark)
    check([(r["doc_id"], r["text"]) for r in df.collect()], P.pack(df).collect(), 2048)
    assert P.pack(none(spark)).collect() == []
