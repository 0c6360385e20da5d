"""Sink writers.

Each target is a callable ``(batch_df, batch_id) -> None`` used inside
``foreachBatch``.  ``split_writer`` writes the main and the late rows of one
micro-batch from a single pass over the batch (persisted once, written twice).

Delivery: ``commits.CommittedTable`` shows every batch once, at every moment.
The other targets are at-least-once with the means to drop repeats: the plain
file target writes a folder per batch id that a replayed batch overwrites (a
reader may find it missing meanwhile), Kafka records carry the batch id in a
header, JDBC rows in a column, besides the idempotent key (productKey,
deviceName, eventName, gmtCreate).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.schema import CHANGE_EVENT_COLUMNS
from devdelta.sinks.records import as_kafka, column_event_records, keyed_event_records

Target = Callable[[DataFrame, int], None]


BATCH_ID = "batch_id"


def file_target(path: str, fmt: str = "parquet") -> Target:
    """One folder per batch id, overwritten on replay."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{BATCH_ID}={batch_id}")

    return write


def kafka_records(df: DataFrame, topic: str, batch_id: int, keyed: bool = True) -> DataFrame:
    """Change events as Kafka columns (keyed beans, or path B's layout without a key), with the batch id as a header."""
    header = F.array(F.struct(F.lit(BATCH_ID).alias("key"), F.lit(str(batch_id)).cast("binary").alias("value")))
    records = keyed_event_records(df) if keyed else column_event_records(df)
    return as_kafka(records, topic).withColumn("headers", header)


def kafka_target(bootstrap_servers: str, topic: str, options: dict | None = None, keyed: bool = True) -> Target:
    """K1/K2/K3: change events to a Kafka topic (needs the Kafka connector)."""

    def write(df: DataFrame, batch_id: int) -> None:
        (
            kafka_records(df, topic, batch_id, keyed)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("includeHeaders", "true")
            .options(**(options or {}))
            .save()
        )

    return write


def jdbc_rows(df: DataFrame, batch_id: int) -> DataFrame:
    """The ten change-event columns and the batch id."""
    return df.select(*CHANGE_EVENT_COLUMNS, F.lit(batch_id).cast("long").alias(BATCH_ID))


def jdbc_target(url: str, table: str, properties: dict) -> Target:
    """K5: append the change events to a database table.  Credentials come only from ``properties``."""

    def write(df: DataFrame, batch_id: int) -> None:
        jdbc_rows(df, batch_id).write.jdbc(url=url, table=table, mode="append", properties=properties)

    return write


def insert_target(table: str) -> Target:
    """K3: ``INSERT INTO`` a catalog table of the ten columns, by position."""

    def write(df: DataFrame, batch_id: int) -> None:
        view = f"_batch_{table.replace('.', '_').replace('`', '')}"
        df.select(*CHANGE_EVENT_COLUMNS).createOrReplaceTempView(view)
        df.sparkSession.sql(f"INSERT INTO {table} SELECT * FROM {view}")

    return write


def console_target(prefix: str) -> Target:
    """K4: print every row of a batch as JSON after a prefix, on the executors' standard output."""

    def show(rows: Iterator) -> None:
        for r in rows:
            print(f"{prefix}{r[0]}", flush=True)

    def write(df: DataFrame, batch_id: int) -> None:
        df.select(F.to_json(F.struct(*(F.col(c) for c in df.columns)))).foreachPartition(show)

    return write


def fan_out(*targets: Target) -> Target:
    """K6: several targets for the same rows; the batch is computed once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for t in targets:
                t(df, batch_id)
        finally:
            df.unpersist()

    return write


def split_writer(main: Target, late: Target | None = None, flag: str = "is_late") -> Target:
    """One pass, two outputs -- rows with ``flag`` go to ``late``.

    The batch is persisted once; an output without rows in this batch gets an
    empty write, which adds nothing.  (``commits.CommittedTable`` partitioned by
    the flag writes both from one pass without persisting.)
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for target, rows in ((main, df.where(~F.col(flag))), (late, df.where(F.col(flag)))):
                if target is not None:
                    target(rows.drop(flag), batch_id)
        finally:
            df.unpersist()

    return write
