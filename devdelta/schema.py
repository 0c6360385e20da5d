"""Schemas: Kafka-shaped source rows, the snapshot envelope, change events."""

from __future__ import annotations

from pyspark.sql import types as T

# Kafka-shaped row, as delivered by the Kafka source (timestampType omitted).
KAFKA_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
# One parse of the message.  Envelope fields stay VARIANT so that the JSON
# type is known (missing field = SQL NULL, JSON null = variant null); items keep
# message order because they are read as a MAP.
SNAPSHOT_PARSE_DDL = (
    "deviceType variant, iotId variant, requestId variant, checkFailedData variant, "
    "productKey variant, deviceName variant, gmtCreate variant, "
    "items map<string, struct<value: variant, time: variant>>"
)

# Path B reads ``items`` as text, exactly as it stands in the message (an object
# or a string that holds one).
TABLE_PARSE_DDL = (
    "deviceType variant, iotId variant, requestId variant, checkFailedData variant, "
    "productKey variant, deviceName variant, gmtCreate variant, items string"
)

# Change event (main and late output), field order of the event object.
CHANGE_EVENT_FIELDS = (
    ("deviceType", T.StringType()),
    ("iotId", T.StringType()),
    ("requestId", T.StringType()),
    ("checkFailedData", T.StringType()),
    ("productKey", T.StringType()),
    ("gmtCreate", T.LongType()),
    ("deviceName", T.StringType()),
    ("eventName", T.StringType()),
    ("eventValue", T.StringType()),
    ("eventOriValue", T.StringType()),
)
CHANGE_EVENT_COLUMNS = [n for n, _ in CHANGE_EVENT_FIELDS]
