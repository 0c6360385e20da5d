"""Record layouts of the change-event sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.functions.keys import java_concat
from devdelta.schema import CHANGE_EVENT_COLUMNS

# Bean-style layout: fields in name order, NULL fields left out.
BEAN_FIELD_ORDER = sorted(CHANGE_EVENT_COLUMNS)


def keyed_event_records(events: DataFrame) -> DataFrame:
    """K1/K2: key ``productKey-deviceName`` (NULL parts print ``null``), value =
    JSON object of the ten fields in name order without NULL fields."""
    return events.select(
        java_concat(F.col("productKey"), "-", F.col("deviceName")).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in BEAN_FIELD_ORDER])).alias("value"),
    )


def table_event_records(diff_view: DataFrame) -> DataFrame:
    """K3: the path B sink table -- diff columns mapped by position to the
    ten sink columns, JSON value in column order with NULLs written, no key."""
    renamed = diff_view.select(
        "deviceType",
        "iotId",
        "requestId",
        "checkFailedData",
        "productKey",
        "gmtCreate",
        "deviceName",
        F.col("event_name").alias("eventName"),
        F.col("event_value").alias("eventValue"),
        F.col("event_ori_value").alias("eventOriValue"),
    )
    return column_event_records(renamed)


def column_event_records(events: DataFrame) -> DataFrame:
    """The ten columns of ``events`` in column order, NULLs written, no key."""
    return events.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in CHANGE_EVENT_COLUMNS]), {"ignoreNullFields": "false"}).alias("value"),
    )


def as_kafka(records: DataFrame, topic: str) -> DataFrame:
    """Columns the Kafka sink expects: ``topic``, ``key`` and ``value`` as bytes."""
    return records.select(
        F.lit(topic).alias("topic"), F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )
