"""Keyed state of both processors, driven batch by batch without Spark."""

import random

import pytest

from devdelta.streaming import change_processor as cp
from devdelta.streaming import lag_processor as lp
from state_fakes import Times, batch, rows_of, started


def prop(t, value, offset=0, name="T"):
    return (t, 0, offset, "D", "i", "r", "{}", "P", "d", name, f"{name}:{value}", f"{name}:")


def snap(t, items, offset=0):
    return (t, 0, offset, "D", "i", "r", "{}", "P", "d", items)


def changes(out):
    return [(r.gmtCreate, r.eventValue, r.eventOriValue) for r in out if not r.is_late]


def reference_changes(rows):
    """The rules in the plainest form: sorted, first arrival of a time, compared with the row before."""
    out, prev, last = [], None, None
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if r[0] == last:
            continue
        if prev is None or prev != r[10]:
            out.append((r[0], r[10], r[11] if prev is None else prev))
        prev, last = r[10], r[0]
    return out


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_late_rows_apart_the_stream_equals_the_plain_rules(width):
    rng = random.Random(width)
    all_late = 0
    for _ in range(40):
        rows = sorted((prop(rng.randrange(1, 200), rng.randrange(3), i) for i in range(80)), key=lambda r: r[0] + rng.randrange(40))
        p = cp.ChangeLogProcessor(width)
        handle, out, fed, late, wm = started(p), [], [], 0, 0
        while rows:
            n = rng.randrange(1, 12)
            part, rows = rows[:n], rows[n:]
            late += sum(wm > 0 and r[0] <= wm for r in part)
            fed += [r for r in part if not (wm > 0 and r[0] <= wm)]
            out += batch(p, handle, wm, rows_of(cp.INPUT_COLUMNS, part))
            wm = max(wm, max(r[0] for r in part) - 21)
        out += batch(p, handle, 10**6)
        assert sum(r.is_late for r in out) == late
        assert changes(out) == reference_changes(fed)
        all_late += late
    assert all_late > 0


def test_slices_equal_one_list():
    rng = random.Random(1)
    rows = [prop(rng.randrange(1, 500), rng.randrange(3), i) for i in range(300)]
    for width in (1, 13, 10**6):
        p = cp.ChangeLogProcessor(width)
        handle, out = started(p), []
        for i in range(0, 300, 37):
            out += batch(p, handle, 0, rows_of(cp.INPUT_COLUMNS, rows[i : i + 37]))
        for wm in (40, 41, 333, 501, 502):
            out += batch(p, handle, wm)
        assert changes(out) == reference_changes(rows)
        assert not handle.map.entries and handle.value.value[3] == [] and not handle.timers


def test_the_boundary_of_lateness():
    p = cp.ChangeLogProcessor(100)
    handle = started(p)
    out = batch(p, handle, 1000, rows_of(cp.INPUT_COLUMNS, [prop(999, 1), prop(1000, 2), prop(1001, 3)]))
    assert [(r.gmtCreate, r.is_late) for r in out] == [(999, True), (1000, True)]
    assert changes(batch(p, handle, 1001)) == []  # released once the watermark has passed time + 1
    assert changes(batch(p, handle, 1002)) == [(1001, "T:3", "T:")]


def test_times_that_no_timestamp_holds_go_to_the_late_output():
    p = cp.ChangeLogProcessor(100)
    handle = started(p)
    out = batch(p, handle, 0, rows_of(cp.INPUT_COLUMNS, [prop(10**18, 1), prop(-(10**17), 1), prop(5, 1)]))
    assert [r.gmtCreate for r in out if r.is_late] == [10**18, -(10**17)]
    assert handle.value.value[3] == [5]


def test_a_release_does_not_touch_what_waits():
    """State calls and moved text of a release are the same with 10 and with 100,000 rows waiting."""

    def release(waiting):
        p = cp.ChangeLogProcessor(1000)
        handle = started(p)
        rows = [prop(t, t % 3, t) for t in range(1, 1001)]
        rows += [prop(10_000 + 50 * i, i % 3, i) for i in range(waiting)]
        batch(p, handle, 0, rows_of(cp.INPUT_COLUMNS, rows))
        handle.calls = handle.moved = 0
        assert len(changes(batch(p, handle, 1500))) > 0
        return handle.calls, handle.moved

    few, many = release(10), release(100_000)
    assert few == many

    def lag_release(waiting):
        p = lp.SnapshotLagProcessor(1000)
        handle = started(p)
        rows = [snap(t, "{}", t) for t in range(1, 1001)] + [snap(10_000 + 50 * i, "{}", i) for i in range(waiting)]
        batch(p, handle, 0, rows_of(lp.INPUT_COLUMNS, rows))
        handle.calls = handle.moved = 0
        assert len(batch(p, handle, 1500)) == 1000
        return handle.calls, handle.moved

    assert lag_release(10) == lag_release(100_000)


def test_initial_state_is_the_baseline():
    p = cp.ChangeLogProcessor(100)
    handle = started(p)
    p.handleInitialState(None, {"t": 50, "value": "T:1"}, Times(0))
    out = batch(p, handle, 0, rows_of(cp.INPUT_COLUMNS, [prop(40, 9), prop(50, 9), prop(60, 1), prop(70, 2)]))
    assert [r.gmtCreate for r in out if r.is_late] == [40, 50]
    assert changes(batch(p, handle, 1000)) == [(70, "T:2", "T:1")]  # no first-seen row
    p = lp.SnapshotLagProcessor(100)
    handle = started(p)
    p.handleInitialState(None, {"t": 50, "value": "old"}, Times(0))
    batch(p, handle, 0, rows_of(lp.INPUT_COLUMNS, [snap(60, "new")]))
    assert [(r.newData, r.oldData) for r in batch(p, handle, 100)] == [("new", "old")]


def test_idle_expiry_on_the_wall_clock():
    now = [0]
    p = lp.SnapshotLagProcessor(100, idle_ttl_ms=1000, clock=lambda: now[0])
    handle = started(p)

    def send(wall, t, items, wm):
        now[0] = wall
        return [(r.newData, r.oldData) for r in batch(p, handle, wm, rows_of(lp.INPUT_COLUMNS, [snap(t, items)]))]

    send(0, 10, "a", 0)
    assert batch(p, handle, 10)[0].newData == "a"
    send(900, 5000, "b", 10)  # far on by event time, soon by the wall
    assert [(r.newData, r.oldData) for r in batch(p, handle, 5000)] == [("b", "a")]
    send(2000, 5001, "c", 5000)  # next by event time, silent by the wall
    assert [(r.newData, r.oldData) for r in batch(p, handle, 5001)] == [("c", None)]
    now[0] = 2500
    batch(p, handle, 7000)
    assert handle.value.value[1] == "c"  # event time alone forgets nothing
    now[0] = 9000
    batch(p, handle, 9000)
    assert handle.value.value is None and not handle.map.entries and not handle.timers


def test_idle_expiry_on_event_time_clears_the_state():
    p = lp.SnapshotLagProcessor(100, idle_ttl_ms=1000)
    handle = started(p)
    batch(p, handle, 0, rows_of(lp.INPUT_COLUMNS, [snap(10, "a")]))
    assert len(batch(p, handle, 500)) == 1 and handle.timers == {1010}
    batch(p, handle, 1010)
    assert handle.value.value is None and not handle.timers
