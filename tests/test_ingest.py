"""Ingestion details: coercions per JSON type, the key rule, the path B table."""

import os
import tempfile

from conftest import message
from pyspark.sql import functions as F

from devdelta.functions.json_text import as_text_sql, json_bigint_sql, long_value_sql, text_value_sql
from devdelta.operators.parse import key_is_json, snapshot_messages, snapshot_table
from devdelta.sinks.writers import fan_out, file_target, split_writer
from devdelta.sources.files import kafka_rows


def _leaf(spark, json_value):
    df = spark.createDataFrame([(f'{{"v": {json_value}}}',)], "s string")
    return df.select(F.from_json("s", "v variant")["v"].alias("v"))


def test_coercions_per_json_type(spark):
    cases = {
        '"x"': ("x", "x", 0, None),
        "7": (None, "7", 7, 7),
        "3.0": (None, "3.0", 3, 3),
        "-2.9": (None, "-2.9", -2, -2),
        "1e3": (None, "1000.0", 1000, 1000),
        "0.00001": (None, "1.0E-5", 0, 0),
        "12345678901234567890": (None, "12345678901234567890", 0, None),
        "true": (None, "true", 0, None),
        "null": (None, "null", 0, None),
        '{"a": 1}': (None, "", 0, None),
        "[1, 2]": (None, "", 0, None),
        '" 42 "': (" 42 ", " 42 ", 0, 42),
    }
    for raw, (tv, at, lv, fb) in cases.items():
        row = _leaf(spark, raw).select(
            F.expr(text_value_sql("v")).alias("tv"),
            F.expr(as_text_sql("v")).alias("at"),
            F.expr(long_value_sql("v")).alias("lv"),
            F.expr(json_bigint_sql("v")).alias("fb"),
        ).first()
        assert (row.tv, row.at, row.lv, row.fb) == (tv, at, lv, fb), raw


def test_missing_leaf_is_null(spark):
    df = spark.createDataFrame([("{}",)], "s string").select(F.from_json("s", "v variant")["v"].alias("v"))
    row = df.select(F.expr(as_text_sql("v")).alias("a"), F.expr(long_value_sql("v")).alias("l")).first()
    assert row.a is None and row.l is None


def test_key_rule(spark):
    keys = [None, '"k"', '{"a":1,"a":2}', "12", "not json", ""]
    df = spark.createDataFrame([(None if k is None else k.encode(),) for k in keys], "key binary")
    got = [r[0] for r in df.select(key_is_json(F.col("key"))).collect()]
    assert got == [True, True, True, True, False, False]


def test_gate_needs_all_seven_fields(spark):
    base = message([("T", 1, 1)])
    vals = [base] + [message([("T", 1, 1)], drop=(f,)) for f in
                     ("deviceType", "iotId", "requestId", "checkFailedData", "productKey", "deviceName")]
    assert snapshot_messages(kafka_rows(spark, vals)).count() == 1
    # the message's own gmtCreate is not required by path A
    assert snapshot_messages(kafka_rows(spark, [message([("T", 1, 1)], drop=("gmtCreate",))])).count() == 1


def test_snapshot_table_text_rules(spark):
    vals = [message([("A", 1, 1)], iotId=5, gmtCreate="1700"), message([("A", 1, 1)], drop=("deviceType",))]
    rows = sorted(snapshot_table(kafka_rows(spark, vals)).collect(), key=lambda r: r.offset)
    assert rows[0].iotId == "5" and rows[0].gmtCreate == 1700
    assert rows[1].deviceType is None and rows[1].gmtCreate == 1000


def test_file_target_is_idempotent_per_batch(spark):
    root = tempfile.mkdtemp(prefix="run-sink-", dir="/tmp")
    df = spark.createDataFrame([(1, False), (2, True)], "x int, is_late boolean")
    w = split_writer(file_target(f"{root}/main"), file_target(f"{root}/late"))
    w(df, 0)
    w(df, 0)  # a replayed batch overwrites its own output
    w(df, 1)
    assert sorted(r.x for r in spark.read.parquet(f"{root}/main").collect()) == [1, 1]
    assert sorted(r.x for r in spark.read.parquet(f"{root}/late").collect()) == [2, 2]
    seen = []
    fan_out(lambda d, b: seen.append(d.count()), lambda d, b: seen.append(b))(df, 7)
    assert seen == [2, 7]
    assert os.path.isdir(f"{root}/main/batch_id=0")
