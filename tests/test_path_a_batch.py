"""Path A hand cases (FIXTURES.md, table "Path A, batch")."""

from conftest import message

from devdelta.operators.changelog import change_log, first_seen
from devdelta.operators.parse import property_events, snapshot_messages
from devdelta.sources.files import kafka_rows


def run(spark, values, keys=None):
    raw = kafka_rows(spark, values, keys)
    out = change_log(property_events(snapshot_messages(raw)))
    return sorted((r.eventName, r.gmtCreate, r.eventValue, r.eventOriValue) for r in out.collect())


def test_a1_only_changes(spark):
    vals = [message([("Light", 0, 1)]), message([("Light", 0, 2)]), message([("Light", 1, 3)])]
    assert run(spark, vals) == [("Light", 1, "Light:0", "Light:"), ("Light", 3, "Light:1", "Light:0")]


def test_a2_out_of_order_arrival(spark):
    vals = [message([("Light", 1, 3)]), message([("Light", 0, 1)])]
    assert run(spark, vals) == [("Light", 1, "Light:0", "Light:"), ("Light", 3, "Light:1", "Light:0")]


def test_a3_same_time_first_arrival_wins(spark):
    vals = [message([("Light", 0, 1)]), message([("Light", 5, 1)])]
    assert run(spark, vals) == [("Light", 1, "Light:0", "Light:")]


def test_a4_linked_group(spark):
    vals = [
        message([("CookbookID", 3, 1), ("StOvMode", 1, 2)]),
        message([("CookbookID", 3, 11), ("StOvMode", 2, 12)]),
    ]
    g1, o1 = "CookbookID:3,StOvMode:1", "CookbookID:,StOvMode:"
    assert run(spark, vals) == [
        ("CookbookID", 1, g1, o1),
        ("StOvMode", 2, g1, o1),
        ("StOvMode", 12, "CookbookID:3,StOvMode:2", g1),
    ]


def test_a5_only_first_code_part_counts(spark):
    vals = [message([("T", "a:b", 1)]), message([("T", "a:c", 2)])]
    assert run(spark, vals) == [("T", 1, "T:a:b", "T:")]


def test_a6_case_sensitive(spark):
    vals = [message([("T", "on", 1)]), message([("T", "ON", 2)])]
    assert run(spark, vals) == [("T", 1, "T:on", "T:"), ("T", 2, "T:ON", "T:on")]


def test_a7_empty_value(spark):
    vals = [message([("T", "", 1)]), message([("T", "x", 2)])]
    assert run(spark, vals) == [("T", 1, "T:", "T:"), ("T", 2, "T:x", "T:")]


def test_a8_gate(spark):
    good = message([("T", "x", 1)])
    vals = [
        message([("T", "x", 1)], drop=("deviceType",)),
        message([], drop=("items",)),
        "not json",
        good,
    ]
    keys = [None, None, None, "not json either"]
    assert run(spark, vals, keys) == []
    assert run(spark, [good], ['"k"']) == [("T", 1, "T:x", "T:")]


def test_a9_null_envelope_field_kept(spark):
    raw = kafka_rows(spark, [message([("T", "x", 1)], deviceType=None)])
    rows = change_log(property_events(snapshot_messages(raw))).collect()
    assert len(rows) == 1 and rows[0].deviceType is None


def test_a9b_non_string_envelope_is_null(spark):
    raw = kafka_rows(spark, [message([("T", "x", 1)], iotId=5)])
    rows = change_log(property_events(snapshot_messages(raw))).collect()
    assert len(rows) == 1 and rows[0].iotId is None


def test_a10_json_null_value(spark):
    assert run(spark, [message([("T", None, 1)])]) == [("T", 1, "T:null", "T:")]


def test_a11_empty_or_non_object_items(spark):
    vals = [message([]), message([], drop=("items",))[:-1] + ',"items":"str"}']
    assert run(spark, vals) == []


def test_a12_compare_with_previous_row(spark):
    vals = [message([("T", "x", t)]) if v == "x" else message([("T", v, t)]) for v, t in
            [("x", 1), ("x", 2), ("y", 3), ("x", 4)]]
    assert run(spark, vals) == [("T", 1, "T:x", "T:"), ("T", 3, "T:y", "T:x"), ("T", 4, "T:x", "T:y")]


def test_value_and_time_coercions(spark):
    vals = [message([("A", 3.0, 1.9), ("B", True, "9"), ("C", {"q": 1}, 5), ("D", 1e3, 6), ("E", ..., 7)])]
    assert run(spark, vals) == [
        ("A", 1, "A:3.0", "A:"),
        ("B", 0, "B:true", "B:"),
        ("C", 5, "C:", "C:"),
        ("D", 6, "D:1000.0", "D:"),
    ]


def test_repeated_item_name_keeps_last_value(spark):
    vals = [message([("A", 1, 1), ("B", 2, 1), ("A", 7, 2)])]
    assert run(spark, vals) == [("A", 2, "A:7", "A:"), ("B", 1, "B:2", "B:")]


def test_first_seen(spark):
    vals = [message([("Light", 1, 3)]), message([("Light", 0, 1)]), message([("X", 0, 9)])]
    out = first_seen(property_events(snapshot_messages(kafka_rows(spark, vals))))
    assert sorted((r.eventName, r.gmtCreate) for r in out.collect()) == [("Light", 1), ("X", 9)]


def test_null_key_parts_group_as_text_null(spark):
    vals = [message([("T", "a", 1)], productKey=None), message([("T", "a", 2)], productKey="null")]
    assert run(spark, vals) == [("T", 1, "T:a", "T:")]


def test_legacy_joined_key_collides_like_the_original(spark):
    from devdelta.config import Settings

    vals = [
        message([("T", "a", 1)], productKey="p_x", deviceName="d"),
        message([("T", "a", 2)], productKey="p", deviceName="x_d"),
    ]
    events = property_events(snapshot_messages(kafka_rows(spark, vals)))
    assert change_log(events).count() == 2  # two keys, both first seen
    assert change_log(events, Settings(legacy_joined_key=True)).count() == 1  # one joined key, no change
