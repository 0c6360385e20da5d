"""WARC archives of pages, and one globally ordered index of their captures.

* ``write_archives``: a WARC/1.1 record per page, its block an HTTP response
  with the page's html.  Of records with equal payloads (SHA-1 and length) of at
  least ``least`` bytes, the one with the largest page_id is the response, the
  others are revisits: HTTP headers without a body and WARC-Refers-To.  Largest
  ids come from a pre-aggregated group and are joined to the pages, so a payload
  that a third of all pages share is spread over tasks by the join.  The
  archives are written by Spark's text writer with a record's end (two CRLF) as
  separator, compressed file by file.
* ``read_runs``: Spark's text reader streams each archive, cut at the same
  separator, and records are taken out by their Content-Length, so no archive
  is held whole, whatever its size.  An archive's captures (``records_per_file``
  at most), with digests of the payloads that were read and the record's place
  in the unpacked archive, are sorted locally by URL key and time: a run.  The
  runs are written to the shared folder.
* ``merge_runs``: the runs are cut at ranges of (URL key, time, page, record),
  as many as their captures ask for, so that a range holds about ``RANGE_ROWS``
  of them even if all are of one URL, one time or one page.  Spark's sort brings
  each run's piece of a range in its own order; the pieces are merged k-way by a
  loser tree over iterators.  Ranges follow each other, so the whole is one
  ordered capture history: an index with archive, offset and length.

Null html: empty payload.  Null url: empty.  Null and repeated page ids: every
row is a record with an id of its own; of equal rows one is the response.  Empty
table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby, islice
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devdelta.llm.common import row_id, staged
from devdelta.session import scratch_path

LEAST = 1000
RECORDS_PER_FILE = 5000
RANGE_ROWS = 100_000  # captures of a range that one task merges, about
EPOCH = 1_577_836_800  # pages without a capture time: seconds after 2020-01-01 by page_id
END = "\r\n\r\n"


def _record_uri(page: Column, uid: str) -> Column:
    number = F.concat(F.hex(f"{uid}.f"), F.lit("-"), F.col(f"{uid}.r").cast("string"))
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), number, F.lit(">"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST, captured: Column | None = None, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``."""
    at = F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.col("page_id"), F.lit(0))) if captured is None else captured
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\x00-\x20]", "").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        row_id(pages).alias("uid"),
    )
    base = base.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("n", F.octet_length("html"))
    best = base.groupBy("digest", "n").agg(F.max(F.struct("page_id", "uid")).alias("best"))
    rows = base.join(best, ["digest", "n"])
    revisit = (F.col("n") >= least) & (F.col("uid") != F.col("best.uid"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        _record_uri(F.col("page_id"), "uid"),
        F.lit("\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit("\r\nWARC-Date: "),
        F.col("at"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                _record_uri(F.col("best.page_id"), "best.uid"),
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )
    writer = rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


class _Stream:
    """Reads on from the pieces of an archive between record ends, without holding it whole."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, bytearray(), 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        self.held += END.encode()
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (i := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        out = bytes(self.held[:i])
        del self.held[: i + len(mark)]
        self.at += i + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        self.at += n
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def url_key(url: str) -> str:
    """Host labels from the top down, then path and query."""
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def _page(uri: str) -> int | None:
    number = uri.strip("<>").split(":")[2]
    return None if number == "none" else int(number)


def captures(pieces: Iterator[bytes]) -> Iterator[tuple]:
    """NAMES of the records of an archive, which comes as the pieces between its record ends."""
    stream = _Stream(pieces)
    # A block that ends with CRLF may leave a separator more behind the last record: an empty head.
    while (start := stream.at) is not None and (head := stream.until(END.encode())):
        f = _fields(head)
        block = stream.take(int(f["content-length"]))
        length = stream.at - start
        stream.take(len(END))
        http, _, payload = block.partition(END.encode())
        kind = f["warc-type"]
        if kind == "response":
            size, digest, refers = len(payload), hashlib.sha1(payload).hexdigest(), None
        else:
            size, digest, refers = int(_fields(http)["content-length"]), f["warc-payload-digest"].removeprefix("sha1:"), _page(f["warc-refers-to"])
        yield url_key(f["warc-target-uri"]), f["warc-date"], _page(f["warc-record-id"]), size, digest, kind, refers, start, length


NAMES = ["urlkey", "captured", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "offset", "length"]
TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
DDL = "urlkey string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
DDL += ", offset long, length long, archive string"


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives below ``path``; a run (one archive's) is sorted, ``place`` counts in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = ((name, line) for b in batches for name, line in zip(b["archive"].to_pylist(), b["value"].to_pylist()))
        for name, mine in groupby(lines, key=lambda x: x[0]):  # an archive's lines come together, in order
            rows = sorted(captures(line for _, line in mine), key=_order)
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), TYPES)]
            extra = [pa.array([name] * len(rows)), pa.array(range(len(rows)), pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, *extra], [*NAMES, "archive", "place"])

    lines = spark.read.option("lineSep", END).schema("value string").text(path)
    # A compressed file isn't split: one task streams it.
    return lines.select(F.col("_metadata.file_name").alias("archive"), F.col("value").cast("binary")).mapInArrow(run, DDL + ", place long")


def loser_tree_merge(runs: list[Iterator], key: Callable) -> Iterator:
    """Merge sorted iterators; each inner node of the tree keeps the loser of its match, the winner goes up."""
    runs = [iter(r) for r in runs]
    k = len(runs)
    if not k:
        return
    heads: list = [None] * k
    keys: list[tuple] = [()] * k

    def step(i: int) -> None:
        for heads[i] in runs[i]:
            keys[i] = (0, key(heads[i]), i)
            return
        keys[i] = (1, i)  # after every key

    for i in range(k):
        step(i)
    tree = [-1] * k
    for i in range(k):  # play the leaves in, one after the other
        winner, node = i, (i + k) // 2
        while node > 0:
            if tree[node] == -1:
                tree[node] = winner
                winner = -1
                break
            if keys[tree[node]] < keys[winner]:
                tree[node], winner = winner, tree[node]
            node //= 2
        if winner != -1:
            tree[0] = winner
    while keys[tree[0]][0] == 0:
        i = tree[0]
        yield heads[i]
        step(i)
        winner, node = i, (i + k) // 2
        while node > 0:
            if keys[tree[node]] < keys[winner]:
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner


def _piece(rows: pa.Table, start: int, end: int, step: int = 1000) -> Iterator[tuple]:
    """(order, row number) of a run's piece, some rows at a time."""
    for a in range(start, end, step):
        part = rows.slice(a, min(step, end - a))
        keys = zip(*(part[n].to_pylist() for n in NAMES[:3]))
        yield from zip(map(_order, keys), range(a, a + part.num_rows))


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures, ordered by URL key, time and page from the first partition to the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        code = rows["archive"].combine_chunks().dictionary_encode().indices.to_numpy()
        edges = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)] if len(code) else [0]
        merged = loser_tree_merge([_piece(rows, a, b) for a, b in zip(edges, edges[1:])], lambda x: x[0])
        while taken := [i for _, i in islice(merged, 10_000)]:
            yield from rows.take(taken).drop_columns(["place"]).combine_chunks().to_batches()

    ranges = max(1, -(-runs.count() // range_rows))
    cut = runs.repartitionByRange(ranges, "urlkey", "captured", "page_id", "archive", "place")
    return cut.sortWithinPartitions("archive", "place").mapInArrow(run, DDL)


def archive_history(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back: the ordered capture history."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least)
    return merge_runs(staged(read_runs(spark, path), "capture-runs"))
