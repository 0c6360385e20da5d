"""Path B as a batch: previous snapshot per device, then the native diff.

W1 W2 S5 P4 P5 G3 G4 T10(batch).  The previous snapshot of a device
(productKey, iotId) is the one before it in message-time order; ties are broken
by arrival (partition, offset) -- the original ordered by time alone, which
made tied rows come out wrong.  ``idle_ttl_ms`` forgets a device that was idle
longer than that (its next snapshot is treated as its first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.config import Settings
from devdelta.functions.diff import get_diff_text
from devdelta.functions.keys import key_columns
from devdelta.operators.ordering import PREV, previous_in_key
from devdelta.operators.parse import ARRIVAL

DEVICE_KEYS = ["_k_productKey", "_k_iotId"]
ENVELOPE = ["deviceType", "iotId", "requestId", "checkFailedData", "productKey", "gmtCreate", "deviceName"]


def snapshot_lag(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The lag view: envelope, ``newData`` (items) and ``oldData`` (previous items)."""
    keyed = table.select("*", *key_columns("productKey", "iotId"))
    lagged = previous_in_key(
        keyed,
        keys=DEVICE_KEYS,
        time_col="gmtCreate",
        ties=ARRIVAL,
        carry=["items", "gmtCreate"],
        bucket_ms=settings.lag_bucket_ms,
    )
    old = F.col(PREV)["items"]
    if settings.idle_ttl_ms is not None:
        idle = F.col("gmtCreate") - F.col(PREV)["gmtCreate"] > F.lit(settings.idle_ttl_ms)
        old = F.when(idle, F.lit(None)).otherwise(old)
    return lagged.select(*ENVELOPE, F.col("items").alias("newData"), old.alias("oldData"), *ARRIVAL)


def diff_rows(lag_view: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The diff view: ``INNER JOIN LATERAL getDiff(newData, oldData)`` -- a lag
    row whose diff is empty produces nothing."""
    diff = get_diff_text("newData", "oldData", settings.linked, settings.old_linked)
    return lag_view.select(*ENVELOPE, F.inline(diff))


def snapshot_diff(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return diff_rows(snapshot_lag(table, settings), settings)


def baseline(table: DataFrame) -> DataFrame:
    """The last snapshot of every device, as key columns, ``t`` and ``value`` (its items)."""
    keyed = table.select("*", *key_columns("productKey", "iotId")).where(F.col("gmtCreate").isNotNull())
    last = F.max_by(F.struct(F.col("gmtCreate").alias("t"), F.col("items").alias("value")), F.struct("gmtCreate", *ARRIVAL))
    return keyed.groupBy(*DEVICE_KEYS).agg(last.alias("_last")).select(*DEVICE_KEYS, "_last.t", "_last.value")
