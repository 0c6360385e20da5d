"""Exact duplicates by deterministic block naming.

Each normalised text (A-Z lower-cased, UTF-8) is cut into blocks of a fixed
number of bytes.  The distinct blocks are sorted and named with integers;
adjacent names are paired, the distinct pairs sorted and named in turn, and so
on, until one name is left of every document.  Documents that took the same
number of rounds and got the same name are equal byte for byte, and no others
are.

* Blocks are pre-aggregated before they are shuffled, so a block that a third
  of all rows share costs a row for each task, and each block's bytes are
  shuffled once.  Names are joined back to documents by a 64-bit hash of the
  block; a hash that two different blocks share is found by counting, and its
  blocks are named and joined by their bytes instead, so a collision cannot
  merge texts.
* Later rounds carry integers only.  There are log2(longest text / block)
  rounds; what each needs is written to the shared folder.
* Null or empty text: one empty block, so all such rows are equal.  Null ids,
  repeated ids and repeated rows: every input row is counted and returned; of
  equal rows with equal ids one stays.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import ROW_ID, row_id, staged, utf8

BLOCK_BYTES = 16 * 1024
NONE = -(2**63)  # stands after the last name of an odd number of names


def _blocks(text: str | None, size: int) -> list[bytes]:
    data = utf8(text).lower()  # bytes.lower changes A-Z only
    return [data[i : i + size] for i in range(0, len(data), size)] or [b""]


def _hash(block: bytes) -> int:
    return xxhash.xxh64_intdigest(block) - 2**63


def _members(size: int):
    """(uid, doc_id, text) -> a row for each block, without its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for row, text in enumerate(b["text"].to_pylist()):
                parts = _blocks(text, size)
                sha = hashlib.sha256()
                for pos, part in enumerate(parts):
                    sha.update(part)
                    for col, v in zip(out, (row, len(parts), pos, _hash(part), None)):
                        col.append(v)
                out[4][-len(parts)] = sha.hexdigest()
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string())
            row, *cols = (pa.array(c, t) for c, t in zip(out, types))
            yield pa.RecordBatch.from_arrays([b["uid"].take(row), b["doc_id"].take(row), *cols], ["uid", "doc_id", "n", "pos", "h", "sha"])

    return run


def _contents(size: int, with_uid: bool):
    """(uid, text) -> a row for each block with its hash and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                (row, pos, _hash(part), part)
                for row, text in enumerate(b["text"].to_pylist())
                for pos, part in enumerate(_blocks(text, size))
            ]
            types = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            row, *cols = (pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types))
            uid = [b["uid"].take(row)] if with_uid else []
            yield pa.RecordBatch.from_arrays([*uid, *cols], [*["uid"][: len(uid)], "pos", "h", "block"])

    return run


def _named(distinct: DataFrame, *by: str) -> DataFrame:
    """Integer names for distinct rows: partition number and rank in the sorted partition."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _first_names(rows: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """The members with the names of their blocks."""
    blocks = rows.select("text").mapInArrow(_contents(size, False), "pos int, h long, block binary")
    names = staged(_named(blocks.groupBy("h", "block").agg(F.count("*").alias("c")), "block").select("h", "name"), "names")
    shared = names.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    if shared.isEmpty():
        return members.join(names, "h")
    # Different blocks with one hash: named by their bytes, below zero.
    single = members.join(shared, "h", "left_anti").join(names, "h")
    exact = rows.select("uid", "text").mapInArrow(_contents(size, True), f"uid {ROW_ID}, pos int, h long, block binary")
    exact = exact.join(shared, "h", "left_semi")
    own = _named(exact.select("h", "block").distinct(), "block").withColumn("name", -1 - F.col("name"))
    found = staged(exact.join(staged(own, "exact-names"), ["h", "block"]).select("uid", "pos", "name"), "exact-members")
    rest = members.join(shared, "h", "left_semi").join(found, ["uid", "pos"])
    return single.unionByName(rest)


def document_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(uid, doc_id, level, name, sha): rows with one (level, name) have equal normalised texts."""
    text = F.col("text").cast("string").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, row_id(docs).alias("uid"))
    members = rows.mapInArrow(
        _members(block_bytes), f"uid {ROW_ID}, doc_id long, n int, pos int, h long, sha string"
    )
    members = staged(members, "members")
    level = staged(_first_names(rows, members, block_bytes).select("uid", "doc_id", "n", "pos", "name", "sha"), "level0")
    longest = level.agg(F.max("n")).first()[0] or 0
    done = [_finished(level, 0)]
    rounds = 0
    while longest > 1:
        rounds, longest = rounds + 1, (longest + 1) // 2
        name = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = (
            level.where("n > 1")
            .withColumn("half", F.expr("cast(pos div 2 as int)"))
            .groupBy("uid", "doc_id", "n", "half")
            .agg(name(0).alias("a"), F.coalesce(name(1), F.lit(NONE)).alias("b"), F.max("sha").alias("sha"))
        )
        names = staged(_named(pairs.groupBy("a", "b").agg(F.count("*").alias("c")), "a", "b").drop("c"), "pair-names")
        level = pairs.join(names, ["a", "b"]).select(
            "uid", "doc_id", F.expr("cast((n + 1) div 2 as int)").alias("n"), F.col("half").alias("pos"), "name", "sha"
        )
        level = staged(level, f"level{rounds}")
        done.append(_finished(level, rounds))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _finished(level: DataFrame, rounds: int) -> DataFrame:
    return level.where("n = 1").select("uid", "doc_id", F.lit(rounds).alias("level"), "name", "sha")


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """uid (the row's number), doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    ids = document_names(docs, block_bytes)
    best: Column = F.max(F.struct("doc_id", "uid"))
    groups = ids.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    return ids.join(groups, ["level", "name"]).select(
        "uid",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("best.uid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
