"""Many keys of a processor in one grouping key of Spark, for jobs that touch many keys a batch.

Every grouping key costs a batch a fixed price beside that of its rows: a record batch,
timers and some ten calls to the state server.  A replay, whose batches touch every key, pays
it for all of them.  ``KeySlots`` groups by a *slot*, a hash of the key, and
runs the processor within for each key of the slot in turn, against a handle that reads and writes
the slot's state in memory.  The slot itself is read and written once a call:

* a value state with the head of every key (its value state and timers), one line a key;
* a map state by slice, as the processor's own, whose entry holds the slices of that name of
  all keys, one line a key.  Only slices that a key asks for are read, and written back if changed.

One timer a slot is enough, at the earliest of its keys'.  Lines are JSON without line feeds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from devdelta.streaming.pending import ROWS_SCHEMA, SLICE_SCHEMA, Reader

SLOT = "_slot"
KEYS_SCHEMA = "timer long, keys string"


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


class _Value:
    """The value state of the key at hand."""

    def __init__(self, slots: KeySlots):
        self.slots = slots

    def get(self):
        return self.slots.entry[0]

    def update(self, value) -> None:
        self.slots.entry[0] = value
        self.slots.changed = True

    def clear(self) -> None:
        self.slots.entry[0] = None
        self.slots.changed = True


class _Map:
    """The map state of the key at hand: its line in each slice of the slot."""

    def __init__(self, slots: KeySlots):
        self.slots = slots

    def getValue(self, name):
        got = self.slots.slice(name).get(self.slots.key)
        return None if got is None else (got,)

    def updateValue(self, name, value) -> None:
        self.slots.slice(name)[self.slots.key] = value[0]
        self.slots.touched.add(name)

    def removeKey(self, name) -> None:
        self.slots.slice(name).pop(self.slots.key, None)
        self.slots.touched.add(name)


class KeySlots(StatefulProcessor):
    """``inner``: a processor with one value state and one map state of texts by slice; ``keys``: the key's columns."""

    def __init__(self, inner: StatefulProcessor, keys: Sequence[str]):
        self.inner = inner
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heads = handle.getValueState("keys", KEYS_SCHEMA)
        self.map = handle.getMapState("slices", SLICE_SCHEMA, ROWS_SCHEMA)
        self.read_key = Reader(self.keys)
        self.inner.init(self)

    # --- the handle of the inner processor: the state of the key at hand ---

    def getValueState(self, name, schema) -> _Value:
        return _Value(self)

    def getMapState(self, name, key_schema, value_schema) -> _Map:
        return _Map(self)

    def registerTimer(self, t: int) -> None:
        if t not in self.entry[1]:
            self.entry[1].append(t)
            self.changed = True

    def deleteTimer(self, t: int) -> None:
        if t in self.entry[1]:
            self.entry[1].remove(t)
            self.changed = True

    # --- the slot ---

    def slice(self, name) -> dict[str, str]:
        if name not in self.slices:
            got = self.map.getValue(name) if name in self.held else None
            self.slices[name] = dict(line.split("\t", 1) for line in got[0].split("\n")) if got else {}
        return self.slices[name]

    def _open(self) -> None:
        got = self.heads.get()
        self.timer, lines = (None, []) if got is None else (got[0], got[1].split("\n"))
        self.held = set()  # slices that the slot has in state
        self.state = {}
        if lines:
            self.held = {(s,) for s in json.loads(lines[0])}
            for line in lines[1:]:
                key, entry = line.split("\t", 1)
                self.state[key] = json.loads(entry)
        self.slices: dict[tuple, dict[str, str]] = {}
        self.touched: set[tuple] = set()
        self.changed = False

    def _at(self, key: str) -> None:
        self.key = key
        self.entry = self.state.setdefault(key, [None, []])

    def _close(self) -> None:
        for name in self.touched:
            rows = self.slices[name]
            if rows:
                self.map.updateValue(name, ("\n".join(f"{k}\t{v}" for k, v in rows.items()),))
                self.held.add(name)
            elif name in self.held:
                self.map.removeKey(name)
                self.held.discard(name)
        if not self.changed and not self.touched:
            return
        state = {k: e for k, e in self.state.items() if e[0] is not None or e[1]}
        timer = min((t for e in state.values() for t in e[1]), default=None)
        if timer != self.timer:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            if timer is not None:
                self.handle.registerTimer(timer)
        if state:
            held = _text(sorted(s for (s,) in self.held))
            self.heads.update((timer, "\n".join([held, *(f"{k}\t{_text(e)}" for k, e in state.items())])))
        else:
            self.heads.clear()

    def handleInitialState(self, key, initialState, timerValues: TimerValues) -> None:
        """One row a slot: the initial rows of its keys."""
        self._open()
        for row in initialState["rows"]:
            self._at(_text([row[k] for k in self.keys]))
            self.inner.handleInitialState(None, row, timerValues)
        self._close()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        by_key: dict[tuple, list[Row]] = {}
        for r in rows:
            by_key.setdefault(tuple(self.read_key(r)), []).append(r)
        self._open()
        for k, own in by_key.items():
            self._at(_text(k))
            yield from self.inner.handleInputRows(k, iter(own), timerValues)
        self._close()

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        self._open()
        for k in list(self.state):
            self._at(k)
            for t in sorted(t for t in self.entry[1] if t <= wm):
                if t in self.entry[1]:
                    yield from self.inner.handleExpiredTimer(k, timerValues, ExpiredTimerInfo(t))
                    self.deleteTimer(t)
        self._close()

    def close(self) -> None:
        self.inner.close()


def with_slot(rows: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    return rows.withColumn(SLOT, F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int"))


def initial_slots(baseline: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    """A baseline with one row a slot."""
    row = F.struct(*baseline.columns)
    return with_slot(baseline, keys, slots).groupBy(SLOT).agg(F.collect_list(row).alias("rows"))


def transform(
    rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, ddl: str, baseline: DataFrame | None, slots: int | None
) -> DataFrame:
    """``rows`` by ``keys`` through ``processor``; with ``slots``, that many grouping keys in place of one a key."""
    keys = list(keys)
    if slots:
        rows, processor = with_slot(rows, keys, slots), KeySlots(processor, keys)
        baseline = None if baseline is None else initial_slots(baseline, keys, slots)
        keys = [SLOT]
    return rows.groupBy(*keys).transformWithState(
        processor,
        ddl,
        "Append",
        "EventTime",
        initialState=None if baseline is None else baseline.groupBy(*keys),
    )
