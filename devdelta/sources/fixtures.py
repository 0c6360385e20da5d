"""Device snapshot messages derived from the ``events`` table.

The test data has no device topic, so snapshot messages are derived from the
``events`` rows: one message per (user, day); one property per event type seen
that day, carrying the latest (ts, event_id) event's ``props.k % 4`` as value
and its time in epoch milliseconds.  Messages come out Kafka-shaped (``key``,
``value`` bytes, ``topic``, ``partition``, ``offset``, ``timestamp``) so that the
same ingestion code reads them as it would read the topic.

Everything is one aggregation on (user_id, day): per event type a conditional
``max`` of (ts, event_id, ...) is partially aggregated before the shuffle, so a
very active user costs one small row per input partition and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdelta.config import ENVELOPE_TEXT_FIELDS, SOURCE_TOPIC

# --- fixed values: event type of the test data -> device property ----------
# (listed in property-name order, which is also the item order of a message)
EVENT_PROPERTIES: tuple[tuple[str, str], ...] = (
    ("click", "CookbookID"),
    ("error", "ErrorCode"),
    ("purchase", "LStOvMode"),
    ("signup", "Light"),
    ("view", "StOvMode"),
)
# ---------------------------------------------------------------------------
N_PARTITIONS = 8


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds (floor) of a wall-clock timestamp, zone-independent."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    us = F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))
    return ((us - F.pmod(us, F.lit(1000))) / F.lit(1000)).cast("long")


def device_columns(user_id: Column) -> dict[str, Column]:
    """Envelope of the device standing for a user."""
    return {
        "deviceType": F.concat(F.lit("T"), (user_id % 3).cast("string")),
        "iotId": F.concat(F.lit("iot"), user_id.cast("string")),
        "productKey": F.concat(F.lit("P"), (user_id % 5).cast("string")),
        "deviceName": F.concat(F.lit("dev"), user_id.cast("string")),
    }


def property_name(event_type: Column) -> Column:
    expr = None
    for etype, name in EVENT_PROPERTIES:
        expr = (F.when(event_type == etype, F.lit(name)) if expr is None else expr.when(event_type == etype, F.lit(name)))
    return expr


def event_rows(events: DataFrame) -> DataFrame:
    """Per event: user, day, ms, value code and arrival id (pruned columns only)."""
    return events.select(
        "user_id",
        "event_id",
        "event_type",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("ts").cast("timestamp_ntz").cast("date").alias("day"),
        epoch_ms(F.col("ts")).alias("ms"),
        (F.from_json("props", "k bigint")["k"] % 4).alias("code"),
    )


def fixture_messages(events: DataFrame, topic: str = SOURCE_TOPIC, n_partitions: int = N_PARTITIONS) -> DataFrame:
    """Kafka-shaped snapshot messages, one per (user_id, day)."""
    latest = [
        f"max(CASE WHEN event_type = '{etype}' THEN struct(ts, event_id, code, ms) END) AS _p{i}"
        for i, (etype, _) in enumerate(EVENT_PROPERTIES)
    ]
    msg = event_rows(events).groupBy("user_id", "day").agg(
        F.min("event_id").alias("first_event_id"), F.max("ms").alias("last_ms"), *[F.expr(x) for x in latest]
    )
    entries = ", ".join(
        f"CASE WHEN _p{i} IS NOT NULL THEN named_struct('key', '{name}', "
        f"'value', named_struct('value', _p{i}.code, 'time', _p{i}.ms)) END"
        for i, (_, name) in enumerate(EVENT_PROPERTIES)
    )
    body = (
        "named_struct("
        "'deviceType', concat('T', CAST(user_id % 3 AS STRING)), "
        "'iotId', concat('iot', CAST(user_id AS STRING)), "
        "'requestId', CAST(first_event_id AS STRING), "
        "'checkFailedData', '{}', "
        "'productKey', concat('P', CAST(user_id % 5 AS STRING)), "
        "'gmtCreate', last_ms, "
        "'deviceName', concat('dev', CAST(user_id AS STRING)), "
        f"'items', map_from_entries(filter(array({entries}), e -> e IS NOT NULL)))"
    )
    return msg.selectExpr(
        "CAST(concat('\"iot', CAST(user_id AS STRING), '\"') AS BINARY) AS key",
        f"CAST(to_json({body}) AS BINARY) AS value",
        f"'{topic}' AS topic",
        f"CAST(pmod(user_id, {int(n_partitions)}) AS INT) AS partition",
        "first_event_id AS offset",
        "timestamp_millis(last_ms) AS timestamp",
    )


def raw_property_events(events: DataFrame, truncate_to_day: bool = True) -> DataFrame:
    """One change-event candidate per raw event (no message grouping).

    With ``truncate_to_day`` the time is the day's first millisecond, so one
    device property has many rows with the same time; ``offset`` = event_id is
    the arrival order.  Used to exercise same-time de-duplication at volume.
    """
    ev = event_rows(events)
    dev = device_columns(F.col("user_id"))
    name = property_name(F.col("event_type"))
    t = epoch_ms(F.col("day").cast("timestamp_ntz")) if truncate_to_day else F.col("ms")
    return ev.select(
        dev["deviceType"].alias("deviceType"),
        dev["iotId"].alias("iotId"),
        F.col("event_id").cast("string").alias("requestId"),
        F.lit("{}").alias("checkFailedData"),
        dev["productKey"].alias("productKey"),
        t.alias("gmtCreate"),
        dev["deviceName"].alias("deviceName"),
        name.alias("eventName"),
        F.concat(name, F.lit(":"), F.col("code").cast("string")).alias("eventValue"),
        F.concat(name, F.lit(":")).alias("eventOriValue"),
        F.pmod(F.col("user_id"), F.lit(N_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


EDGE_KINDS = 16


def edge_messages(events: DataFrame, topic: str = SOURCE_TOPIC, n_partitions: int = N_PARTITIONS) -> DataFrame:
    """One Kafka-shaped message per event, each sixteenth of them with another irregularity.

    All report the property ``Mode``.  By ``event_id % 16``: 0 nothing odd, 1 a
    fractional number, 2 text that differs in case, 3 text with a colon, 4 a
    property beside it that is not an object, 5 no time, 6 no value, 7 not JSON,
    8 a key that is not JSON, 9 no deviceType, 10 deviceType null, 11 deviceType
    a number, 12 a time cut to the hour (ties), 13 the name repeated, 14 a null
    value, 15 an object as value.
    """
    rows = event_rows(events).withColumn("kind", F.col("event_id") % EDGE_KINDS)
    t = "CASE WHEN kind = 12 THEN ms - pmod(ms, 3600000L) ELSE ms END"
    value = (
        "CASE kind WHEN 1 THEN concat(code, '.0') WHEN 2 THEN if(code % 2 = 0, '\\\"On\\\"', '\\\"ON\\\"') "
        "WHEN 3 THEN if(code % 2 = 0, '\\\"a:b\\\"', '\\\"a:c\\\"') WHEN 14 THEN 'null' WHEN 15 THEN '{\\\"a\\\":1}' ELSE CAST(code AS STRING) END"
    )
    mode = (
        f"concat('\\\"Mode\\\":{{', CASE kind WHEN 5 THEN concat('\\\"value\\\":', {value}) WHEN 6 THEN concat('\\\"time\\\":', {t}) "
        f"ELSE concat('\\\"value\\\":', {value}, ',\\\"time\\\":', {t}) END, '}}')"
    )
    items = (
        f"concat('{{', CASE kind WHEN 4 THEN '\\\"Bad\\\":5,' WHEN 13 THEN '\\\"Mode\\\":{{\\\"value\\\":9,\\\"time\\\":0}},' ELSE '' END, {mode}, '}}')"
    )
    device = (
        "CASE kind WHEN 9 THEN '' WHEN 10 THEN '\\\"deviceType\\\":null,' WHEN 11 THEN '\\\"deviceType\\\":7,' "
        "ELSE concat('\\\"deviceType\\\":\\\"T', user_id % 3, '\\\",') END"
    )
    body = (
        f"concat('{{', {device}, '\\\"iotId\\\":\\\"iot', user_id, '\\\",\\\"requestId\\\":\\\"', event_id, '\\\",\\\"checkFailedData\\\":\\\"{{}}\\\",', "
        f"'\\\"productKey\\\":\\\"P', user_id % 5, '\\\",\\\"gmtCreate\\\":', ms, ',\\\"deviceName\\\":\\\"dev', user_id, '\\\",\\\"items\\\":', {items}, '}}')"
    )
    return rows.selectExpr(
        "CAST(CASE WHEN kind = 8 THEN 'not json' END AS BINARY) AS key",
        f"CAST(CASE WHEN kind = 7 THEN concat('no message ', event_id) ELSE {body} END AS BINARY) AS value",
        f"'{topic}' AS topic",
        f"CAST(pmod(user_id, {int(n_partitions)}) AS INT) AS partition",
        "event_id AS offset",
        "timestamp_millis(ms) AS timestamp",
    )


DROP_KINDS = 23


def drop_messages(events: DataFrame, topic: str = SOURCE_TOPIC, n_partitions: int = N_PARTITIONS) -> DataFrame:
    """One Kafka-shaped message per event, most with a fault for which it, or a property, is left out.

    By ``event_id % 23``: 0 and 1 none, 2 a key that is not JSON, 3 a value that is
    not JSON, 4 an array, 5 no value, 6-11 without the first to sixth envelope
    field, 12 without items, 13 items empty, 14 items a text, 15 items null, 16 a
    property beside it that is no object, 17 one without time, 18 one without
    value, 19 a time in nanoseconds, 20 a 19-digit number, 21 and 22 two members
    of the linked group that ``fixture_messages`` has no events for.
    """
    rows = event_rows(events).withColumn("kind", F.col("event_id") % DROP_KINDS)
    mode = """concat('"Mode":{"value":', CASE kind WHEN 20 THEN concat('123456789012345678', code) ELSE CAST(code AS STRING) END,
              ',"time":', CASE kind WHEN 19 THEN ms * 1000000 ELSE ms END, '}')"""
    group = """concat('"MultiStageName":{"value":', code, ',"time":', ms, '},"RStOvState":{"value":', code, ',"time":', ms, '}')"""
    beside = """CASE kind WHEN 16 THEN '"Bad":5,' WHEN 17 THEN '"Half":{"value":1},' WHEN 18 THEN '"Half":{"time":1},' ELSE '' END"""
    items = f"""CASE WHEN kind = 12 THEN '' WHEN kind = 13 THEN ',"items":{{}}' WHEN kind = 14 THEN ',"items":"x"'
                WHEN kind = 15 THEN ',"items":null' WHEN kind IN (21, 22) THEN concat(',"items":{{', {group}, '}}')
                ELSE concat(',"items":{{', {beside}, {mode}, '}}') END"""
    values = {
        "deviceType": "concat('T', user_id % 3)",
        "iotId": "concat('iot', user_id)",
        "requestId": "CAST(event_id AS STRING)",
        "checkFailedData": "'{}'",
        "productKey": "concat('P', user_id % 5)",
        "deviceName": "concat('dev', user_id)",
    }
    fields = ", ".join(
        f"""CASE WHEN kind = {6 + i} THEN '' ELSE concat('"{name}":"', {values[name]}, '",') END"""
        for i, name in enumerate(ENVELOPE_TEXT_FIELDS)
    )
    body = f"""concat('{{', {fields}, '"gmtCreate":', ms, {items}, '}}')"""
    return rows.selectExpr(
        "CAST(CASE WHEN kind = 2 THEN 'not json' END AS BINARY) AS key",
        f"CAST(CASE kind WHEN 3 THEN 'no message' WHEN 4 THEN '[1]' WHEN 5 THEN NULL ELSE {body} END AS BINARY) AS value",
        f"'{topic}' AS topic",
        f"CAST(pmod(user_id, {int(n_partitions)}) AS INT) AS partition",
        "event_id AS offset",
        "timestamp_millis(ms) AS timestamp",
    )


def timed_messages(events: DataFrame, at_ms: int, topic: str = SOURCE_TOPIC, n_partitions: int = N_PARTITIONS) -> DataFrame:
    """One message per event with the property ``Edge``, its time just below, at or just above ``at_ms`` (by ``event_id % 3``)."""
    t = f"({int(at_ms)}L - 1 + event_id % 3)"
    body = (
        "concat('{\"deviceType\":\"T', user_id % 3, '\",\"iotId\":\"iot', user_id, '\",\"requestId\":\"', event_id, "
        "'\",\"checkFailedData\":\"{}\",\"productKey\":\"P', user_id % 5, '\",\"gmtCreate\":', "
        f"{t}, ',\"deviceName\":\"dev', user_id, '\",\"items\":{{\"Edge\":{{\"value\":', code, ',\"time\":', {t}, '}}}}}}')"
    )
    return event_rows(events).selectExpr(
        "CAST(NULL AS BINARY) AS key",
        f"CAST({body} AS BINARY) AS value",
        f"'{topic}' AS topic",
        f"CAST(pmod(user_id, {int(n_partitions)}) AS INT) AS partition",
        "event_id AS offset",
        f"timestamp_millis({t}) AS timestamp",
    )
