"""Kafka source (S1-S3, S6-S9): streaming and bounded reads of the topic.

Start positions of the original consumer and their equivalents:

* ``latest`` / ``earliest`` -> ``startingOffsets``;
* ``timestamp`` (ms) -> ``startingTimestamp``;
* ``group`` (committed consumer-group offsets) has no direct twin: a
  Structured Streaming query resumes from its own checkpoint, so the first run
  starts from ``latest`` (the consumer default) and later runs continue where
  the checkpoint left off.  The group id is still passed for monitoring.

The connector jar is not bundled; these functions only build the reader.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdelta.config import SOURCE_TOPIC

KAFKA_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def kafka_options(
    bootstrap_servers: str,
    topic: str = SOURCE_TOPIC,
    start: str | int = "latest",
    group_id: str | None = None,
    extra: dict | None = None,
    partitions: Sequence[int] | None = None,
) -> dict[str, str]:
    """``partitions``: read these partitions of the topic only."""
    if not bootstrap_servers:
        raise ValueError("bootstrap_servers is required")
    opts = {"kafka.bootstrap.servers": bootstrap_servers}
    if partitions is None:
        opts["subscribe"] = topic
    else:
        opts["assign"] = json.dumps({topic: list(partitions)})
    if isinstance(start, int) and not isinstance(start, bool):
        opts["startingTimestamp"] = str(start)
    elif start in ("latest", "earliest"):
        opts["startingOffsets"] = start
    elif start == "group":
        opts["startingOffsets"] = "latest"
    else:
        raise ValueError(f"unknown start position {start!r}")
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str = SOURCE_TOPIC, start: str | int = "latest",
                 group_id: str | None = None, extra: dict | None = None, partitions: Sequence[int] | None = None) -> DataFrame:
    """Unbounded Kafka-shaped rows (the stream never ends by itself)."""
    opts = kafka_options(bootstrap_servers, topic, start, group_id, extra, partitions)
    return spark.readStream.format("kafka").options(**opts).load().select(*[F.col(c) for c in KAFKA_COLUMNS])


def kafka_batch(spark: SparkSession, bootstrap_servers: str, topic: str = SOURCE_TOPIC, start: str | int = "earliest",
                end: str = "latest", extra: dict | None = None) -> DataFrame:
    """Bounded read of the topic (replays, backfills) for the batch plans."""
    opts = kafka_options(bootstrap_servers, topic, start, None, extra)
    opts["endingOffsets"] = end
    return spark.read.format("kafka").options(**opts).load().select(*[F.col(c) for c in KAFKA_COLUMNS])
