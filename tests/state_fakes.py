"""In-memory state of one key for processors, counting calls and the text that they move."""


class Times:
    def __init__(self, wm):
        self.wm = wm

    def getCurrentWatermarkInMs(self):
        return self.wm


class Value:
    def __init__(self, handle):
        self.handle, self.value = handle, None

    def get(self):
        self.handle.calls += 1
        return self.value

    def update(self, value):
        self.handle.calls += 1
        self.value = tuple(value)

    def clear(self):
        self.handle.calls += 1
        self.value = None


class Map:
    def __init__(self, handle):
        self.handle, self.entries = handle, {}

    def getValue(self, key):
        self.handle.calls += 1
        got = self.entries.get(key)
        self.handle.moved += len(got[0]) if got else 0
        return got

    def updateValue(self, key, value):
        self.handle.calls += 1
        self.handle.moved += len(value[0])
        self.entries[key] = value

    def removeKey(self, key):
        self.handle.calls += 1
        del self.entries[key]


class Handle:
    def __init__(self):
        self.timers, self.calls, self.moved = set(), 0, 0

    def getValueState(self, name, schema):
        self.value = Value(self)
        return self.value

    def getMapState(self, name, key_schema, value_schema):
        self.map = Map(self)
        return self.map

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)

    def deleteTimer(self, t):
        self.calls += 1
        self.timers.discard(t)


class InputRow(tuple):
    """A row of the input: a tuple with field names."""

    __fields__: list


def rows_of(columns, rows):
    out = []
    for r in rows:
        row = InputRow(r)
        row.__fields__ = list(columns)
        out.append(row)
    return out


def batch(processor, handle, wm, rows=()):
    """One micro-batch of a key: input, then the expired timers in order; returns all output."""
    out = list(processor.handleInputRows(None, iter(rows), Times(wm))) if rows else []
    for t in sorted(x for x in handle.timers if x <= wm):
        if t in handle.timers:
            out += processor.handleExpiredTimer(None, Times(wm), t)
            handle.timers.discard(t)
    return out


def started(processor):
    handle = Handle()
    processor.init(handle)
    return handle
