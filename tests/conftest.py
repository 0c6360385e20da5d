import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from devdelta.session import local_session  # noqa: E402
from devdelta.streaming.jobs import use_rocksdb  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="devdelta-tests")
    use_rocksdb(s)
    yield s


ENV = {
    "deviceType": "T1",
    "iotId": "i1",
    "requestId": "r1",
    "checkFailedData": "{}",
    "productKey": "P1",
    "deviceName": "d1",
    "gmtCreate": 1000,
}


def message(items, drop=(), **env):
    """Message text; ``items`` is a list of (name, value, time) kept in order
    (repeated names allowed).  ``value``/``time`` of ``...`` leave the field out."""
    parts = []
    for name, value, t in items:
        fields = []
        if value is not ...:
            fields.append(f'"value":{json.dumps(value)}')
        if t is not ...:
            fields.append(f'"time":{json.dumps(t)}')
        parts.append(f'{json.dumps(name)}:{{{",".join(fields)}}}')
    body = {**ENV, **env}
    for d in drop:
        body.pop(d, None)
    head = ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in body.items())
    if "items" in drop:
        return "{" + head + "}"
    return "{" + head + ',"items":{' + ",".join(parts) + "}}"
