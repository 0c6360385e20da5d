"""Many keys in one slot: what a processor of its own for each key gives, for few calls."""

import random

from devdelta.plans import catalogue
from devdelta.streaming import change_processor as cp
from devdelta.streaming import lag_processor as lp
from devdelta.streaming.key_slots import KeySlots
from state_fakes import Times, batch, rows_of, started

KEYS = ["k", "eventName"]


def prop(key, t, value, offset):
    return (key, t, 0, offset, "D", "i", "r", "{}", "P", "d", "T", f"T:{value}", "T:")


def snap(key, t, items, offset):
    return (key, t, 0, offset, "D", "i", "r", "{}", key, "d", items)


def run(make, columns, keys, batches, initial):
    """(output by slot, output by key): each batch is (watermark, rows)."""
    slot = KeySlots(make(), keys)
    handle, own, together, apart = started(slot), {}, [], []
    slot.handleInitialState(None, {"rows": initial}, Times(0))
    for row in initial:
        own[row["k"]] = p, h = (lambda p: (p, started(p)))(make())
        p.handleInitialState(None, row, Times(0))
    for wm, rows in batches:
        together.append(sorted(map(repr, batch(slot, handle, wm, rows_of(["k", *columns], rows)))))
        out = []
        for key in {r[0] for r in rows} | set(own):
            if key not in own:
                own[key] = (lambda p: (p, started(p)))(make())
            mine = [r[1:] for r in rows if r[0] == key]
            out += batch(*own[key], wm, rows_of(columns, mine))
        apart.append(sorted(map(repr, out)))
    return together, apart, handle, [h for _, h in own.values()]


def test_a_slot_equals_its_keys_on_path_a():
    for seed in range(8):
        rnd = random.Random(seed)
        keys = [f"k\t{i}\n \"" for i in range(9)]
        initial = [{"k": k, "eventName": "T", "t": 40, "value": "T:1"} for k in keys[:3]]
        batches, wm = [], 0
        for b in range(8):
            rows = [prop(rnd.choice(keys), rnd.randrange(wm, wm + 300), rnd.randrange(3), b * 100 + i) for i in range(40)]
            batches.append((wm, rows))
            wm += rnd.randrange(0, 200)
        batches.append((10**6, []))
        together, apart, handle, _ = run(lambda: cp.ChangeLogProcessor(70), cp.INPUT_COLUMNS, KEYS, batches, initial)
        assert together == apart and any(together)
        assert not handle.map.entries and not handle.timers


def test_a_slot_equals_its_keys_on_path_b_with_idle_expiry():
    for seed in range(8):
        rnd = random.Random(seed)
        initial = [{"k": k, "t": 10, "value": f"old {k}"} for k in "ab"]
        batches, wm = [], 0
        for b in range(12):
            rows = [snap(rnd.choice("abcdef"), rnd.randrange(wm, wm + 900), f"{b}\t\n{i}", b * 100 + i) for i in range(rnd.randrange(6))]
            batches.append((wm, rows))
            wm += rnd.randrange(0, 700)
        batches += [(10**6, []), (2 * 10**6, [])]
        make = lambda: lp.SnapshotLagProcessor(100, idle_ttl_ms=400)
        together, apart, handle, _ = run(make, lp.INPUT_COLUMNS, ["k"], batches, initial)
        assert together == apart and any(together)
        assert not handle.map.entries and not handle.timers and handle.value.value is None


def test_calls_do_not_follow_the_keys():
    rows = [prop(f"k{i}", 5 + i % 3, 1, i) for i in range(1000)]
    _, _, handle, own = run(lambda: cp.ChangeLogProcessor(1000), cp.INPUT_COLUMNS, KEYS, [(0, rows), (100, [])], [])
    assert handle.calls < 20 and sum(h.calls for h in own) > 5000


def test_a_release_reads_due_slices_only():
    slot = KeySlots(cp.ChangeLogProcessor(1000), KEYS)
    handle = started(slot)
    batch(slot, handle, 0, rows_of(["k", *cp.INPUT_COLUMNS], [prop(f"k{i}", i, i, i) for i in range(20_000)]))
    handle.moved = 0
    held = {name: len(v[0]) for name, v in handle.map.entries.items()}
    assert len(batch(slot, handle, 1500)) == 1500
    assert handle.moved <= held[0,] + 2 * held[1,]


def test_state_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/events.parquet")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    monkeypatch.setattr(catalogue, "PARTITION_EVENTS", 30)
    with catalogue._replay_session(spark, str(tmp_path)):
        assert spark.conf.get(key) == "34"
    assert spark.conf.get(key) == before


def test_slots_in_a_stream_equal_keys(spark, tmp_path):
    """Both paths from a baseline, with slots and without."""
    from datetime import datetime, timedelta
    from dataclasses import replace

    at = datetime(2024, 1, 1)
    kinds = ["click", "error", "purchase", "signup", "view"]
    rows = [(i, at + timedelta(hours=i, seconds=i % 7), i % 13, kinds[i % 5], 1.0, f'{{"k": {i * i % 11}}}') for i in range(400)]
    ddl = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/events.parquet")
    for name, plain in (("stream_from_backfill", "change_log"), ("stream_snapshots_from_backfill", "snapshot_diff")):
        expected = sorted(map(str, catalogue.CATALOGUE[plain](spark, str(tmp_path)).collect()))
        for slots in (2, None):
            catalogue.REPLAY, kept = replace(catalogue.REPLAY, key_slots=slots), catalogue.REPLAY
            try:
                assert sorted(map(str, catalogue.CATALOGUE[name](spark, str(tmp_path)).collect())) == expected
            finally:
                catalogue.REPLAY = kept


def test_messages_of_days_are_those_of_the_days_events(spark, tmp_path):
    from pyspark.sql import functions as F

    ts = ["1969-12-31 23:59:59.9995", "1970-01-01 00:00:00", "2024-01-01 23:59:59.999999", "2024-01-02 00:00:00", "2024-01-02 12:00:00", None]
    rows = [(i, t, u, "click", '{"k": 1}') for i, (t, u) in enumerate((t, u) for t in ts for u in (1, 2, None))]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    of_message = F.floor(F.unix_millis("timestamp") / F.lit(86_400_000))
    for cut in (-1, 0, 1, 19723, 19724):
        filtered = catalogue.messages(spark, str(tmp_path)).where(of_message >= cut).collect()
        assert sorted(map(repr, catalogue.messages(spark, str(tmp_path), catalogue._day() >= cut).collect())) == sorted(map(repr, filtered))
