"""Path A in a stream: keyed event-time buffering, release and comparison.

T1 T3 T4 T5 T6 T7 T8 P9.  Per key (productKey, deviceName, eventName):

* a row whose time is at or below the watermark in force (once there is one)
  is late: it is passed on flagged ``is_late`` and never touches the state; so
  is a row whose time no timestamp can hold (it could never be released), and,
  if the stream starts from a batch result, one that is not newer than its key's
  baseline there;
* other rows wait until the watermark passes ``time + 1``; then all due rows
  are released at once, in time order, a repeated time keeping its first
  arrival (partition, offset);
* the first row ever released for the key is emitted as it is; every later
  row is compared with the row released just before it (the previous *row*,
  emitted or not) and emitted with ``eventOriValue`` = that row's
  ``eventValue`` when its code differs;
* the newest released row stays in state as the baseline for the next release.

The pending rows lie in slices of event time (``streaming.pending``).  With an
initial state (``handleInitialState``) a key begins with the baseline of a batch
run over the history: no second first-seen row.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from devdelta.functions.codes import py_changed_against
from devdelta.functions.json_text import FIRST_MS, LAST_MS
from devdelta.streaming.pending import Head, PendingRows, Reader, T

PAYLOAD = ("deviceType", "iotId", "requestId", "checkFailedData", "productKey", "deviceName")
INPUT_COLUMNS = ["t", "partition", "offset", *PAYLOAD, "eventName", "eventValue", "eventOriValue"]
NAME, VALUE, ORI = 9, 10, 11
OUTPUT_DDL = (
    "is_late boolean, deviceType string, iotId string, requestId string, checkFailedData string, "
    "productKey string, gmtCreate long, deviceName string, eventName string, eventValue string, "
    "eventOriValue string"
)


def _out(p: list, is_late: bool, ori: str | None = None) -> Row:
    return Row(
        is_late=is_late,
        deviceType=p[3],
        iotId=p[4],
        requestId=p[5],
        checkFailedData=p[6],
        productKey=p[7],
        gmtCreate=p[T],
        deviceName=p[8],
        eventName=p[NAME],
        eventValue=p[VALUE],
        eventOriValue=p[ORI] if ori is None else ori,
    )


class ChangeLogProcessor(StatefulProcessor):
    """``width_ms``: event time in one slice of pending rows."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = PendingRows(handle, self.width_ms)
        self.read = Reader(INPUT_COLUMNS)

    def handleInitialState(self, key, initialState, timerValues: TimerValues) -> None:
        self.rows.save(Head(t=initialState["t"], value=initialState["value"]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        head, accepted = None, []
        for r in rows:
            p = self.read(r)
            if wm > 0 and p[T] <= wm or not FIRST_MS <= p[T] <= LAST_MS:
                yield _out(p, True)
                continue
            head = head or self.rows.head()
            if head.t is not None and p[T] <= head.t:
                yield _out(p, True)
            else:
                accepted.append(p)
        if accepted:
            before = head.pending[:1]
            self.rows.add(head, accepted)
            self.rows.save(head)
            if head.pending[:1] != before:
                self.handle.registerTimer(head.pending[0] + 1)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        head = self.rows.head()
        released = False
        for p in self.rows.due(head, wm):
            if released and p[T] == head.t:
                continue  # same time: the first arrival stays
            if head.t is None:
                yield _out(p, False)
            elif py_changed_against(head.value, p[VALUE], p[NAME]):
                yield _out(p, False, head.value)
            head.t, head.value, released = p[T], p[VALUE], True
        if released:
            self.rows.save(head)
        if head.pending:
            self.handle.registerTimer(head.pending[0] + 1)

    def close(self) -> None:
        pass
