"""Streams driven batch by batch from file drops (FIXTURES.md stream table)."""

import os
import tempfile

from conftest import message

from devdelta.sinks.writers import file_target, split_writer
from devdelta.sources.files import file_stream, kafka_rows
from devdelta.streaming.jobs import change_log_stream, run_available, snapshot_diff_stream, snapshot_lag_stream
from devdelta.config import Settings


def _drive(spark, batches, build, writer_for, root):
    off = 0
    for items in batches:
        if items:
            vals = [message(i) if isinstance(i, list) else i for i in items]
            kafka_rows(spark, vals, first_offset=off).coalesce(1).write.mode("append").parquet(f"{root}/in")
            off += len(vals)
        run_available(build(file_stream(spark, f"{root}/in")), writer_for(root), f"{root}/ckpt")


def _read(spark, path, cols):
    if not os.path.exists(path):
        return []
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


def test_path_a_stream_table(spark):
    root = tempfile.mkdtemp(prefix="run-stream-a-", dir="/tmp")
    batches = [
        [[("T", "x", 100000)]],
        [[("T", "y", 120000)]],
        [[("T", "q", 200000)]],
        [[("T", "L", 60000)], [("T", "M", 95000)], [("T", "ok", 210000)]],
        [[("T", "e", 170000)], [("T", "N", 160000)], [("T", "z", 400000)], [("U", "late", 1000)]],
        [],
    ]
    writer = lambda r: split_writer(file_target(f"{r}/main"), file_target(f"{r}/late"))
    _drive(spark, batches, change_log_stream, writer, root)
    cols = ["eventName", "gmtCreate", "eventValue", "eventOriValue"]
    assert _read(spark, f"{root}/main", cols) == [
        ("T", 100000, "T:x", "T:"),
        ("T", 120000, "T:y", "T:x"),
        ("T", 200000, "T:q", "T:y"),
        ("T", 210000, "T:ok", "T:q"),
    ]
    assert _read(spark, f"{root}/late", cols) == [
        ("T", 60000, "T:L", "T:"),
        ("T", 95000, "T:M", "T:"),
        ("T", 160000, "T:N", "T:"),
        ("T", 170000, "T:e", "T:"),
        ("U", 1000, "U:late", "U:"),
    ]


def test_path_a_stream_equals_batch_on_shuffled_input(spark):
    """Out-of-order arrival within the bound, ties, linked group: the stream's
    released rows equal the batch change log."""
    from devdelta.operators.changelog import change_log
    from devdelta.operators.parse import property_events, snapshot_messages

    msgs = [
        [("Light", 1, 5000), ("CookbookID", 3, 5000), ("StOvMode", 1, 5001)],
        [("Light", 0, 1000)],
        [("Light", 0, 3000), ("StOvMode", 2, 3000)],
        [("Light", 7, 3000)],
        [("CookbookID", 4, 9000), ("StOvMode", 2, 9000)],
        [("Light", 1, 20000)],
    ]
    flush = [("Zflush", 0, 10_000_000)]
    root = tempfile.mkdtemp(prefix="run-stream-eq-", dir="/tmp")
    writer = lambda r: split_writer(file_target(f"{r}/main"), file_target(f"{r}/late"))
    _drive(spark, [msgs[:3], msgs[3:], [flush], []], change_log_stream, writer, root)
    cols = ["eventName", "gmtCreate", "eventValue", "eventOriValue"]
    batch = change_log(property_events(snapshot_messages(kafka_rows(spark, [message(m) for m in msgs]))))
    expected = sorted(tuple(r) for r in batch.select(*cols).collect())
    got = [r for r in _read(spark, f"{root}/main", cols) if r[0] != "Zflush"]
    assert got == expected
    assert _read(spark, f"{root}/late", cols) == []


def test_path_b_stream_with_idle_expiry(spark):
    day = 24 * 3600 * 1000
    root = tempfile.mkdtemp(prefix="run-stream-b-", dir="/tmp")

    def snap(t, light):
        return message([("Light", light, t)], gmtCreate=t)

    batches = [
        [snap(1000, "0"), snap(2000, "1")],
        [snap(2000 + day + 5, "1")],
        [snap(3 * day, "1"), message([("Zflush", 0, 9 * day)], gmtCreate=9 * day, iotId="other")],
        [],
    ]
    writer = lambda r: file_target(f"{r}/diff")
    build = lambda raw: snapshot_diff_stream(raw, Settings(idle_ttl_ms=day))
    _drive(spark, batches, build, writer, root)
    rows = _read(spark, f"{root}/diff", ["iotId", "gmtCreate", "event_name", "event_value", "event_ori_value"])
    assert rows == [
        ("i1", 1000, "ErrorCode", "ErrorCode:0", "ErrorCode:"),
        ("i1", 2000, "Light", "Light:1", "Light:0"),
        ("i1", 2000 + day + 5, "ErrorCode", "ErrorCode:0", "ErrorCode:"),
        ("i1", 3 * day, "ErrorCode", "ErrorCode:0", "ErrorCode:"),
    ]  # the flush snapshot itself stays pending above the final watermark


def test_path_b_stream_lag_ties_break_by_arrival(spark):
    root = tempfile.mkdtemp(prefix="run-stream-lag-", dir="/tmp")
    vals = [message([("Light", v, 5)], gmtCreate=5) for v in ("a", "b", "c")]
    flush = message([("X", 0, 10**9)], gmtCreate=10**9, iotId="other")
    writer = lambda r: file_target(f"{r}/lag")
    _drive(spark, [vals, [flush], []], snapshot_lag_stream, writer, root)
    rows = _read(spark, f"{root}/lag", ["iotId", "offset", "newData", "oldData"])
    mine = [(o, n, od) for i, o, n, od in rows if i == "i1"]
    assert [m[0] for m in mine] == [0, 1, 2]
    assert mine[0][2] is None and mine[1][2] == mine[0][1] and mine[2][2] == mine[1][1]
