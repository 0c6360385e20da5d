"""Kafka-shaped rows from files (replays, tests) and from literal JSON texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from devdelta.config import SOURCE_TOPIC
from devdelta.schema import KAFKA_ROW


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of Kafka-shaped rows stored as files (e.g. a topic dump)."""
    r = spark.readStream.schema(KAFKA_ROW).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def file_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(KAFKA_ROW).format(fmt).load(path)


def kafka_rows(
    spark: SparkSession,
    values: Sequence[str | None],
    keys: Sequence[str | None] | None = None,
    partition: int = 0,
    first_offset: int = 0,
    topic: str = SOURCE_TOPIC,
) -> DataFrame:
    """Kafka-shaped rows for literal message texts (arrival = list order)."""
    keys = keys if keys is not None else [None] * len(values)
    rows = [
        (
            None if k is None else k.encode(),
            None if v is None else v.encode(),
            topic,
            partition,
            first_offset + i,
            None,
        )
        for i, (k, v) in enumerate(zip(keys, values))
    ]
    return spark.createDataFrame(rows, KAFKA_ROW)
