"""Path A as a batch: de-duplicate, order, first-seen, change detection.

O1 O2 T6 T7 T8 P7 F3 F4 R1.  The key is (productKey, deviceName, eventName);
NULL key parts behave like the text ``null``.  Rows of one key are ordered by
the property's event time; of several rows with the same time the first to
arrive (partition, offset) is kept.  The earliest row of a key is emitted as it
is; every later row is emitted when its code differs from the previous row's
code, with ``eventOriValue`` set to the previous row's full ``eventValue``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.config import Settings
from devdelta.functions.codes import changed_against
from devdelta.functions.keys import key_columns
from devdelta.operators.ordering import FIRST, PREV, first_arrival, previous_in_key
from devdelta.operators.parse import ARRIVAL
from devdelta.schema import CHANGE_EVENT_COLUMNS

KEY_TEXT = ("productKey", "deviceName")
KEYS = ["_k_productKey", "_k_deviceName", "eventName"]
JOINED_KEYS = ["_k_joined"]
BASE_TIME, BASE_VALUE = "_base_t", "_base_value"


def key_names(settings: Settings = Settings()) -> list[str]:
    return JOINED_KEYS if settings.legacy_joined_key else KEYS


def key_exprs(settings: Settings = Settings()) -> list:
    """Grouping columns of path A."""
    if settings.legacy_joined_key:
        joined = F.concat_ws(
            "_", *[F.coalesce(F.col(c), F.lit("null")) for c in KEY_TEXT], F.col("eventName")
        ).alias("_k_joined")
        return [joined]
    return key_columns(*KEY_TEXT)


def _keyed(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """With the key columns; rows that have them already keep them, and so the way they are dealt."""
    if set(key_names(settings)) <= set(events.columns):
        return events
    return events.select("*", *key_exprs(settings))


def dedup_same_time(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """O2/T5: one row per (key, gmtCreate), the first to arrive."""
    keys = key_names(settings) + ["gmtCreate"]
    return first_arrival(_keyed(events, settings), keys, ARRIVAL).select(*CHANGE_EVENT_COLUMNS, *ARRIVAL)


def first_seen(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The earliest row of every key, emitted as it is."""
    keyed = _keyed(events, settings).withColumn("_order", F.struct("gmtCreate", *ARRIVAL))
    return first_arrival(keyed.where(F.col("gmtCreate").isNotNull()), key_names(settings), ["_order"]).select(
        *CHANGE_EVENT_COLUMNS
    )


def change_log(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """T6 + T7: the change log of property events (``property_events`` rows).

    Rows may carry, as ``BASE_VALUE``, the baseline of their key from an earlier
    run: the key's first row is then compared with it instead of being emitted as first seen.
    """
    lagged = previous_in_key(
        _keyed(events, settings),
        keys=key_names(settings),
        time_col="gmtCreate",
        ties=ARRIVAL,
        carry=["eventValue"],
        bucket_ms=settings.lag_bucket_ms,
        dedup_same_time=True,
    )
    prev_value, first = F.col(PREV)["eventValue"], F.col(FIRST)
    if BASE_VALUE in events.columns:
        prev_value = F.when(first, F.col(BASE_VALUE)).otherwise(prev_value)
        first = first & F.col(BASE_TIME).isNull()
    emit = first | changed_against(prev_value, F.col("eventValue"), F.col("eventName"))
    out = lagged.where(emit).withColumn("eventOriValue", F.when(first, F.col("eventOriValue")).otherwise(prev_value))
    return out.select(*CHANGE_EVENT_COLUMNS)


def join_baseline(events: DataFrame, last: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """With the baseline of their key as BASE_TIME and BASE_VALUE.  ``last``: see ``baseline``.

    One join on the key; the baseline has one row a key, so Spark can split a hot key's rows.
    """
    keys = key_names(settings)
    return _keyed(events, settings).join(
        last.select(*keys, F.col("t").alias(BASE_TIME), F.col("value").alias(BASE_VALUE)), keys, "left"
    )


def with_baseline(events: DataFrame, last: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(rows newer than their key's baseline, with BASE_TIME and BASE_VALUE; the late rest).  ``last``: see ``baseline``."""
    return by_baseline(join_baseline(events, last, settings))


def by_baseline(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``join_baseline`` rows: (those newer than their baseline; the late rest)."""
    late = F.coalesce(F.col("gmtCreate") <= F.col(BASE_TIME), F.lit(False))
    return joined.where(~late), joined.where(late).select(*CHANGE_EVENT_COLUMNS, *ARRIVAL)


def later_baseline(last: DataFrame, fresh: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The baseline after ``fresh`` rows, all newer than ``last``."""
    keys = key_names(settings)
    both = last.select(*keys, "t", "value").unionByName(baseline(fresh, settings))
    return both.groupBy(*keys).agg(F.max_by(F.struct("t", "value"), "t").alias("_last")).select(*keys, "_last.t", "_last.value")


def baseline(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The row of every key that the next one will be compared with, as key columns, ``t`` and ``value``.

    The newest time, of equal ones the first arrival; aggregated before the shuffle.
    """
    keyed = _keyed(events, settings).where(F.col("gmtCreate").isNotNull())
    newest = F.struct("gmtCreate", *[(-F.col(c)).alias(c) for c in ARRIVAL])
    last = F.max_by(F.struct(F.col("gmtCreate").alias("t"), F.col("eventValue").alias("value")), newest)
    keys = key_names(settings)
    return keyed.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.t", "_last.value")
