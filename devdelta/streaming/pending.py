"""Pending rows of one key in map state, sliced by time.

``PendingRows`` keeps, per key of a stateful processor,

* a value state, the *head*: the baseline (time and text of the last released
  row, and its reading of the idle clock) and, sorted, the earliest time of
  every pending slice;
* a map state with the pending rows of each slice of ``width_ms`` of event time,
  as one JSON text.

An arrival reads the head and writes the slices that its rows fall into; a
release reads the head and the due slices, and rewrites at most the one slice
that the watermark stands in.  The number of state calls follows the rows that
come and go, not those that wait, and no call moves rows that are not due
except in that slice.  One timer, at the earliest pending time, is enough: the
head tells what else is due.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

HEAD_SCHEMA = "t long, value string, clock long, pending array<long>"
SLICE_SCHEMA = "slice long"
ROWS_SCHEMA = "rows string"
T, PART, OFF = 0, 1, 2  # a row is a list that begins with time, partition, offset


@dataclass
class Head:
    t: int | None = None  # of the baseline; None: there is none
    value: str | None = None
    clock: int | None = None
    pending: list[int] = field(default_factory=list)  # the earliest time of each slice that holds rows


class PendingRows:
    def __init__(self, handle: StatefulProcessorHandle, width_ms: int):
        self.width = width_ms
        self.head_state = handle.getValueState("head", HEAD_SCHEMA)
        self.slices = handle.getMapState("slices", SLICE_SCHEMA, ROWS_SCHEMA)

    def head(self) -> Head:
        got = self.head_state.get()
        return Head() if got is None else Head(got[0], got[1], got[2], list(got[3] or ()))

    def save(self, head: Head) -> None:
        """Write the head; a key with neither baseline nor pending rows leaves no state."""
        if head.t is None and not head.pending:
            self.head_state.clear()
        else:
            self.head_state.update((head.t, head.value, head.clock, head.pending))

    def add(self, head: Head, rows: list[list]) -> None:
        """Put ``rows`` into their slices; the caller saves the head."""
        by_slice: dict[int, list[list]] = {}
        for r in rows:
            by_slice.setdefault(r[T] // self.width, []).append(r)
        held = {t // self.width: i for i, t in enumerate(head.pending)}
        fresh = []
        for s, new in by_slice.items():
            first = min(r[T] for r in new)
            if s in held:
                new = json.loads(self.slices.getValue((s,))[0]) + new
                i = held[s]
                head.pending[i] = min(head.pending[i], first)  # stays in its slice, so the order holds
            else:
                fresh.append(first)
            self._write(s, new)
        for first in fresh:
            bisect.insort(head.pending, first)

    def due(self, head: Head, limit: int) -> Iterator[list]:
        """Take out the rows with a time below ``limit``, in order of time and arrival; the caller saves the head."""
        while head.pending and head.pending[0] < limit:
            s = head.pending[0] // self.width
            rows = sorted(json.loads(self.slices.getValue((s,))[0]), key=lambda r: (r[T], r[PART], r[OFF]))
            n = bisect.bisect_left(rows, limit, key=lambda r: r[T])
            if n < len(rows):
                head.pending[0] = rows[n][T]
                self._write(s, rows[n:])
            else:
                head.pending.pop(0)
                self.slices.removeKey((s,))
            yield from rows[:n]

    def _write(self, s: int, rows: list[list]) -> None:
        self.slices.updateValue((s,), (json.dumps(rows, ensure_ascii=False, separators=(",", ":")),))


class Reader:
    """Rows of the input as lists of the named columns, whatever other columns there are."""

    def __init__(self, columns: list[str]):
        self.columns = columns
        self.at: list[int] | None = None

    def __call__(self, row) -> list:
        if self.at is None:
            self.at = [row.__fields__.index(c) for c in self.columns]
        return [row[i] for i in self.at]
