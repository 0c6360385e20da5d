"""Driver contract, sink layouts and source options."""

import json

import duckdb
import pytest
from conftest import message

import __spark_entry__ as entry_mod
from devdelta.operators.changelog import change_log
from devdelta.operators.parse import property_events, snapshot_messages
from devdelta.sinks.records import keyed_event_records, table_event_records
from devdelta.sources.files import kafka_rows
from devdelta.sources.kafka import kafka_options

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:3] == ["deviceType", "iotId", "requestId"]
    assert df.count() > 0


def test_every_query_has_a_callable_and_known_oracles():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert "change_log" in o and "snapshot_diff" in o


@pytest.mark.parametrize("name", ["change_log", "snapshot_diff", "first_seen", "sql_get_diff", "edge_change_log", "edge_snapshot_diff"])
def test_oracle_agrees_at_sf0001(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    res = con.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    duck = sorted(tuple(str(r[cols.index(c)]) for c in sorted(cols)) for r in res.fetchall())
    df = entry_mod.queries()[name](spark, SF)
    mine = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert sorted(df.columns) == sorted(cols)
    assert mine == duck


def test_keyed_records_layout(spark):
    raw = kafka_rows(spark, [message([("T", "x", 1)], productKey=None)])
    rec = keyed_event_records(change_log(property_events(snapshot_messages(raw)))).collect()[0]
    assert rec.key == "null-d1"
    body = json.loads(rec.value)
    assert list(body) == sorted(body) and "productKey" not in body
    assert body["eventValue"] == "T:x" and body["gmtCreate"] == 1


def test_table_records_write_nulls(spark):
    df = spark.createDataFrame(
        [("T1", None, "r", "{}", "P", 5, "d", "A", "A:1", "A:0")],
        "deviceType string, iotId string, requestId string, checkFailedData string, productKey string, "
        "gmtCreate long, deviceName string, event_name string, event_value string, event_ori_value string",
    )
    rec = table_event_records(df).collect()[0]
    assert rec.key is None
    body = json.loads(rec.value)
    assert list(body)[:2] == ["deviceType", "iotId"] and body["iotId"] is None and body["eventName"] == "A"


def test_kafka_options():
    assert kafka_options("b:9092", start="latest")["startingOffsets"] == "latest"
    assert kafka_options("b:9092", start="earliest")["startingOffsets"] == "earliest"
    assert kafka_options("b:9092", start=1680278400000)["startingTimestamp"] == "1680278400000"
    g = kafka_options("b:9092", start="group", group_id="g1")
    assert g["startingOffsets"] == "latest" and g["kafka.group.id"] == "g1"
    assert kafka_options("b:9092")["subscribe"] == "items-model"
    with pytest.raises(ValueError):
        kafka_options("b:9092", start="sometime")
    with pytest.raises(ValueError):
        kafka_options("")
