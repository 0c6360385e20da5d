"""Path B in a stream: the previous snapshot of a device.

``lag`` over event time is not available on a stream, so this processor keeps,
per device (productKey, iotId), the snapshots that wait for the watermark and
the last released one:

* a snapshot at or below the watermark in force is late and dropped (the
  original SQL job dropped late rows too);
* once the watermark reaches a snapshot's time it is released, in time order
  (ties by arrival), paired with the snapshot released before it;
* with ``idle_ttl_ms`` a device idle for longer than that is forgotten: its
  next snapshot is paired with nothing, as a first snapshot would be.

The idle time runs on one of two clocks.  ``event`` (default): the snapshots' own
times, the same in every replay; a timer clears the state of an idle device.
``processing``: the wall clock, as the original state expiry did.  Every snapshot
is stamped on arrival and the stamp waits with it; two snapshots of a device
whose stamps lie further apart than the limit are not paired.  Timers run on event
time, so an idle device's state is cleared at the first event-time check, one
limit after its last snapshot or later, that finds the wall clock past the limit.

The pending snapshots lie in slices of event time (``streaming.pending``).  An
initial state begins a device with the last snapshot of a batch run.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from devdelta.streaming.pending import Head, PendingRows, Reader, T

ENVELOPE = ("deviceType", "iotId", "requestId", "checkFailedData", "productKey", "deviceName")
INPUT_COLUMNS = ["gmtCreate", "partition", "offset", *ENVELOPE, "items_json"]
PART, OFF, ITEMS, STAMP = 1, 2, 9, 10
OUTPUT_DDL = (
    "deviceType string, iotId string, requestId string, checkFailedData string, productKey string, "
    "gmtCreate long, deviceName string, newData string, oldData string, partition int, offset long"
)


def wall_ms() -> int:
    return int(time.time() * 1000)


class SnapshotLagProcessor(StatefulProcessor):
    """``clock``: None for event time, or a function that reads the wall clock in milliseconds."""

    def __init__(self, width_ms: int, idle_ttl_ms: int | None = None, clock: Callable[[], int] | None = None):
        self.width_ms = width_ms
        self.idle_ttl_ms = idle_ttl_ms
        self.clock = clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = PendingRows(handle, self.width_ms)
        self.read = Reader(INPUT_COLUMNS)

    def handleInitialState(self, key, initialState, timerValues: TimerValues) -> None:
        t = initialState["t"]
        now = t if self.clock is None else self.clock()
        self.rows.save(Head(t=t, value=initialState["value"], clock=now))
        if self.idle_ttl_ms is not None:
            self.handle.registerTimer(t + self.idle_ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        accepted = [p for p in map(self.read, rows) if not (wm > 0 and p[T] <= wm)]
        if accepted:
            head = self.rows.head()
            now = None if self.clock is None else self.clock()
            before = head.pending[:1]
            fresh = [p + [p[T] if now is None else now] for p in accepted if head.t is None or p[T] >= head.t]
            self.rows.add(head, fresh)
            if fresh:
                self.rows.save(head)
            if head.pending[:1] != before:
                self.handle.registerTimer(head.pending[0])
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        wm, ttl = timerValues.getCurrentWatermarkInMs(), self.idle_ttl_ms
        head = self.rows.head()
        base_t = head.t
        released = False
        for p in self.rows.due(head, wm + 1):
            if head.t is not None and ttl is not None and p[STAMP] - head.clock > ttl:
                head.t, head.value = None, None
            yield Row(
                deviceType=p[3],
                iotId=p[4],
                requestId=p[5],
                checkFailedData=p[6],
                productKey=p[7],
                gmtCreate=p[T],
                deviceName=p[8],
                newData=p[ITEMS],
                oldData=None if head.t is None else head.value,
                partition=p[PART],
                offset=p[OFF],
            )
            head.t, head.value, head.clock, released = p[T], p[ITEMS], p[STAMP], True
        expired = False
        if ttl is not None and head.t is not None and not head.pending and head.t + ttl <= wm:
            expired = self.clock is None or self.clock() - head.clock > ttl
            if expired:
                head.t, head.value, head.clock = None, None, None  # idle past the limit: forget the device
        if released or expired:
            self.rows.save(head)
        if head.pending:
            self.handle.registerTimer(head.pending[0])
        if ttl is not None:
            # One expiry timer per device: the old baseline's goes when a new one comes.
            if base_t is not None and head.t != base_t:
                self.handle.deleteTimer(base_t + ttl)
            if head.t is not None:
                self.handle.registerTimer(max(head.t, wm) + ttl if head.t + ttl <= wm else head.t + ttl)

    def close(self) -> None:
        pass
