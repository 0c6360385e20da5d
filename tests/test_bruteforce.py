"""Randomised: the batch change log equals a brute-force model of the rules.

The model works on the raw message texts with Python's ``json`` (a repeated
name keeps its first position and its last value, like a JSON tree), renders
values as the original did, orders each key's rows by (time, arrival), keeps
the first arrival of a repeated time, emits the first row of each key and every
row whose code differs from the previous row's.
"""

import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from devdelta.config import LINKED_PROPERTIES
from devdelta.operators.changelog import change_log
from devdelta.operators.parse import property_events, snapshot_messages
from devdelta.sources.files import kafka_rows

NAMES = ["Light", "T", "CookbookID", "StOvMode", "LStOvMode"]
VALUES = ["0", "1", "on", "ON", "a:b", "a:c", "x,y", "", 1, 2, None, True]


def render(v):
    if v is None:
        return "null"
    if v is True:
        return "true"
    return str(v)


def pieces_code(text, name):
    for piece in text.split(","):
        parts = piece.split(":")
        if parts[0] == name:
            return parts[1] if len(parts) > 1 else ""
    return None


def changed(prev, cur, name):
    c = pieces_code(cur, name)
    for piece in prev.split(","):
        parts = piece.split(":")
        if parts[0] == name and (parts[1] if len(parts) > 1 else "") != c:
            return True
    return False


def model(texts):
    rows = []
    for offset, text in enumerate(texts):
        msg = json.loads(text)
        items = msg["items"]
        linked = [(k, render(v["value"])) for k, v in items.items() if k in LINKED_PROPERTIES]
        gv = ",".join(f"{k}:{c}" for k, c in linked)
        go = ",".join(f"{k}:" for k, _ in linked)
        for k, v in items.items():
            code = render(v["value"])
            value, ori = (gv, go) if k in LINKED_PROPERTIES else (f"{k}:{code}", f"{k}:")
            rows.append(((msg["productKey"], msg["deviceName"], k), v["time"], offset, value, ori))
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        prev, last_t = None, None
        for _, t, _, value, ori in mine:
            if t == last_t:
                continue
            last_t = t
            if prev is None:
                out.append((key[2], t, value, ori))
            elif changed(prev, value, key[2]):
                out.append((key[2], t, value, prev))
            prev = value
    return sorted(out)


def make_messages(seed, n):
    rnd = random.Random(seed)
    texts = []
    for _ in range(n):
        items = []
        for _ in range(rnd.randint(1, 4)):
            items.append((rnd.choice(NAMES), rnd.choice(VALUES), rnd.randint(0, 6)))
        parts = ",".join(f'{json.dumps(k)}:{{"value":{json.dumps(v)},"time":{t}}}' for k, v, t in items)
        dev = rnd.choice(["d1", "d2"])
        texts.append(
            '{"deviceType":"T","iotId":"i","requestId":"r","checkFailedData":"{}",'
            f'"productKey":"P","deviceName":"{dev}","items":{{{parts}}}}}'
        )
    return texts


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000))
def test_change_log_matches_model(spark, seed):
    texts = make_messages(seed, 40)
    got = change_log(property_events(snapshot_messages(kafka_rows(spark, texts))))
    got = sorted((r.eventName, r.gmtCreate, r.eventValue, r.eventOriValue) for r in got.collect())
    assert got == model(texts)


def text_b(v):
    if v is None:
        return None
    if v is True:
        return "true"
    return str(v)


def group_b(items):
    return "".join(
        f",{n}:{text_b(items[n].get('value')) if text_b(items[n].get('value')) is not None else 'null'}"
        for n in LINKED_PROPERTIES
        if n in items
    )


def model_b(texts):
    msgs = [(json.loads(t), off) for off, t in enumerate(texts)]
    out = []
    for dev in {m["iotId"] for m, _ in msgs}:
        prev = None
        for m, _ in sorted(((m, o) for m, o in msgs if m["iotId"] == dev), key=lambda x: (x[0]["gmtCreate"], x[1])):
            new = m["items"]
            if prev is None:
                ec = new.get("ErrorCode")
                code = "0" if ec is None else (text_b(ec.get("value")) or "null")
                out.append((dev, m["gmtCreate"], "ErrorCode", f"ErrorCode:{code}", "ErrorCode:"))
            else:
                for k, v in new.items():
                    if prev.get(k) is None:
                        continue
                    nv, ov = text_b(v.get("value")), text_b(prev[k].get("value"))
                    if nv is not None and (ov is None or nv.lower() != ov.lower()):
                        if k in LINKED_PROPERTIES:
                            out.append((dev, m["gmtCreate"], k, group_b(new), group_b(prev)))
                        else:
                            out.append((dev, m["gmtCreate"], k, f"{k}:{nv}", f"{k}:{ov if ov is not None else 'null'}"))
            prev = new
    return sorted(out)


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000))
def test_snapshot_diff_matches_model(spark, seed):
    from devdelta.operators.parse import snapshot_table
    from devdelta.operators.snapshot import snapshot_diff

    rnd = random.Random(seed)
    texts = []
    for _ in range(30):
        names = rnd.sample(NAMES + ["ErrorCode", "RStOvState"], rnd.randint(1, 4))
        parts = ",".join(f'{json.dumps(k)}:{{"value":{json.dumps(rnd.choice(VALUES))},"time":1}}' for k in names)
        texts.append(
            '{"deviceType":"T","iotId":"' + rnd.choice(["i1", "i2"]) + '","requestId":"r","checkFailedData":"{}",'
            f'"productKey":"P","deviceName":"d","gmtCreate":{rnd.randint(0, 5)},"items":{{{parts}}}}}'
        )
    got = snapshot_diff(snapshot_table(kafka_rows(spark, texts)))
    got = sorted((r.iotId, r.gmtCreate, r.event_name, r.event_value, r.event_ori_value) for r in got.collect())
    assert got == model_b(texts)
