"""Streaming query builders for both paths, and a runner for bounded replays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from devdelta.config import PATH_B_BOUND_MS, Settings, watermark_delay_ms
from devdelta.functions.json_text import timestamp_ms_sql
from devdelta.functions.keys import key_columns
from devdelta.operators import parse, snapshot
from devdelta.operators.changelog import key_exprs, key_names
from devdelta.streaming import change_processor as cp
from devdelta.streaming import lag_processor as lp
from devdelta.streaming.key_slots import transform

ITEMS_DDL = "map<string, struct<value: string, time: variant>>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful processors keep their state in RocksDB (spills to disk)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _change_log_input(raw: DataFrame, settings: Settings, observe: str | None) -> DataFrame:
    """Property rows under a watermark, slim, with the key columns; the watermark column is dropped:
    rows below the watermark must reach the processor (to be routed as late), and Spark would otherwise
    filter them out ahead of it."""
    events = parse.property_events(parse.snapshot_messages(raw, observe), settings.linked)
    delay = watermark_delay_ms(settings.bound_ms)
    timed = events.withColumn("_et", F.expr(timestamp_ms_sql("gmtCreate")))
    if observe:
        timed = timed.observe(f"{observe}_times", F.count_if(F.col("_et").isNull()).alias("bad_time"))
    timed = timed.withWatermark("_et", f"{delay} milliseconds")
    return timed.select(
        *key_exprs(settings),
        F.col("gmtCreate").alias("t"),
        *[c for c in cp.INPUT_COLUMNS if c != "t"],
    )


def change_log_stream(
    raw: DataFrame | Sequence[DataFrame],
    settings: Settings = Settings(),
    baseline: DataFrame | None = None,
    observe: str | None = None,
) -> DataFrame:
    """Path A stream: Kafka-shaped rows -> change events with ``is_late``.

    ``raw``: one stream, or several, such as one for each group of source
    partitions.  Each then has a watermark of its own and the job's is their
    minimum (Spark's default policy), so that rows of a slow partition aren't late
    because others are ahead; a stream without any rows holds the watermark back.

    ``baseline`` (``changelog.baseline``): the last rows of a batch run over the
    history, with which the keys begin.  It only counts at the first start.

    ``observe``: name of the metrics that count what is left out (``streaming.drops``).
    """
    raws = [raw] if isinstance(raw, DataFrame) else list(raw)
    inputs = [_change_log_input(r, settings, f"{observe}_{i}" if observe else None) for i, r in enumerate(raws)]
    slim = reduce(DataFrame.unionByName, inputs)
    keys = key_names(settings)
    return transform(slim, keys, cp.ChangeLogProcessor(settings.slice_ms), cp.OUTPUT_DDL, baseline, settings.key_slots)


def snapshot_lag_stream(
    raw: DataFrame,
    bound_ms: int = PATH_B_BOUND_MS,
    idle_ttl_ms: int | None = None,
    baseline: DataFrame | None = None,
    clock: Callable[[], int] | None = None,
    slice_ms: int = Settings().slice_ms,
    key_slots: int | None = None,
) -> DataFrame:
    """Path B stream, lag stage: previous snapshot per device (JSON texts).

    ``baseline`` (``snapshot.baseline``): the last snapshots of a batch run.
    ``clock``: reads the wall clock for the idle expiry; None: event time.
    """
    table = parse.snapshot_table(raw).where(F.col("ts_ltz").isNotNull())
    timed = table.withWatermark("ts_ltz", f"{bound_ms} milliseconds")
    slim = timed.select(
        *key_columns("productKey", "iotId"),
        "gmtCreate",
        "partition",
        "offset",
        *lp.ENVELOPE,
        F.col("items").alias("items_json"),
    )
    processor = lp.SnapshotLagProcessor(slice_ms, idle_ttl_ms, clock)
    return transform(slim, snapshot.DEVICE_KEYS, processor, lp.OUTPUT_DDL, baseline, key_slots)


def snapshot_diff_stream(
    raw: DataFrame,
    settings: Settings = Settings(),
    bound_ms: int = PATH_B_BOUND_MS,
    baseline: DataFrame | None = None,
    clock: Callable[[], int] | None = None,
) -> DataFrame:
    """Path B stream: lag stage, then the native diff on the released pairs."""
    if settings.idle_clock == "processing":
        clock = clock or lp.wall_ms
    lagged = snapshot_lag_stream(
        raw, bound_ms, settings.idle_ttl_ms, baseline, clock, settings.slice_ms, settings.key_slots
    )
    return snapshot.diff_rows(lagged.select(*snapshot.ENVELOPE, "newData", "oldData"), settings)


def run_available(stream: DataFrame, writer, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Process everything available now (bounded replay), then stop.  Restarts
    from ``checkpoint`` resume state, offsets and watermark."""
    q = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        q = q.queryName(name)
    query = q.start()
    query.awaitTermination()
    return query
