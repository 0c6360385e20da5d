import gzip
import hashlib
import random
from collections import Counter, defaultdict

from devdelta.llm import warc as W

DDL = "page_id long, url string, html string, run string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)


def expected(rows):
    best = defaultdict(list)
    for p, _, h in rows:
        best[(h or "").encode()].append(p)
    out = []
    for data, ids in best.items():
        top = max((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda x: -1 if x is None else x, reverse=True)):
            again = len(data) >= W.LEAST and n > 0
            out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark):
    rng = random.Random(3)
    big = ["<p>é\r\n\r\nWARC/1.1\r\n\r\n" + "x" * rng.randrange(900, 3000) for _ in range(6)]
    rows = [(i, f"https://www.h{rng.randrange(3)}.example/p{rng.randrange(4)}?q", rng.choice([*big, "", None, "small", "\r\n\r\n"])) for i in range(120)]
    rows += [(None, None, big[0]), (7, "not a url [", big[1]), (200, "http://a/\r\nx: y", "y" * 200_000), (201, "http://[::1", "y" * 200_000)]
    got = W.archive_history(pages(spark, rows)).collect()
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == expected(rows)
    keys = [(r["urlkey"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert keys == sorted(keys)  # ranges follow each other


def test_the_index_leads_to_its_records(spark, tmp_path):
    ends = ["\r\n", "\r", "\r\n\r", "\n\r\n\r\n", "\r\n\r\n", "\r\r\n\r\n\r\n", "x"]
    rows = [(i % 9, f"http://h{i % 2}.org/", ("é" * (i % 4) + end) * 2) for i, end in enumerate(ends * 4)]
    path = str(tmp_path / "archives")
    W.write_archives(pages(spark, rows).repartition(3), path, least=2, records_per_file=5)
    runs = W.read_runs(spark, path)
    data = {f.name: gzip.decompress(f.read_bytes()) for f in (tmp_path / "archives").glob("part-*")}
    assert len(data) > 5 and max(Counter(r["archive"] for r in runs.collect()).values()) <= 5
    for size in (1, 4, 100):  # many ranges, of ties too
        got = W.merge_runs(runs, size).collect()
        order = [(r["urlkey"], r["captured"], r["page_id"]) for r in got]
        assert len(got) == len(rows) and order == sorted(order)
        ids = set()
        for r in got:
            record = data[r["archive"]][r["offset"] : r["offset"] + r["length"]]
            assert data[r["archive"]][r["offset"] + r["length"] :].startswith(b"\r\n\r\n")
            head, _, block = record.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert len(block) == int(fields["Content-Length"]) and fields["WARC-Type"] == r["record_type"]
            ids.add(fields["WARC-Record-ID"])
            if r["record_type"] == "response":
                assert hashlib.sha1(block.partition(b"\r\n\r\n")[2]).hexdigest() == r["payload_digest"]
        assert len(ids) == len(rows)  # repeated page ids too


def test_loser_tree():
    rng = random.Random(1)
    for _ in range(500):
        runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(9))]
        assert list(W.loser_tree_merge(runs, lambda x: x)) == sorted(sum(runs, []))


def test_url_keys():
    assert W.url_key("https://blog.example.com:8080/a/b?c=1#d") == "com,example,blog)/a/b?c=1"
    assert W.url_key("http://x.org") == "org,x)/" and W.url_key("") == ")/"


def test_empty_table(spark):
    assert W.archive_history(pages(spark, [])).collect() == []
