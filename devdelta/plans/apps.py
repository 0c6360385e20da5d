"""The two applications end to end, ready to launch.

* ``start_change_log_app`` (path A): topic -> gate/explode -> keyed event-time
  processor -> main topic + late topic (one pass, ``foreachBatch``).
* ``start_snapshot_diff_app`` (path B): topic -> snapshot lag processor ->
  native diff -> sink topic (column layout of the SQL sink, NULLs written).
* ``change_log_backfill`` / ``snapshot_diff_backfill``: the same rules as
  batch jobs over a bounded dump of the topic (files), written as a table.

Addresses, topics and credentials are parameters only.  The checkpoint folder
defaults to a subfolder of the cluster's ``spark.checkpoint.dir``.

    python -m devdelta.plans.apps path-a --bootstrap host:9092 --sink-bootstrap host:9092 \\
        --sink-topic changes --late-topic late-changes
    python -m devdelta.plans.apps path-b --bootstrap host:9092 --sink-bootstrap host:9092 --sink-topic changes \\
        --also kafka:other:9092/changes --also jdbc:mysql://host/db#changes --also console
    python -m devdelta.plans.apps backfill-a --input /data/items-model --output /data/change_log
    python -m devdelta.plans.apps increment-a --input /data/items-model/day=1 --path /data/changes --number 0
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdelta.config import PATH_A_BOUND_MS, PATH_B_BOUND_MS, PATH_B_IDLE_TTL_MS, SOURCE_TOPIC, Settings
from devdelta.operators import changelog, parse, snapshot
from devdelta.session import apply_cluster_defaults, checkpoint_root
from devdelta.functions.json_text import timestamp_ms_sql
from devdelta.sinks.records import as_kafka, table_event_records
from devdelta.plans.increments import IncrementalChangeLog
from devdelta.sinks.targets import event_columns, target_from
from devdelta.sinks.writers import Target, fan_out, kafka_target, split_writer
from devdelta.sources.files import file_batch
from devdelta.sources.kafka import kafka_stream
from devdelta.streaming import jobs
from devdelta.streaming.drops import DropCounter


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    if checkpoint:
        return checkpoint
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/devdelta/{name}"


def start_change_log_app(
    spark: SparkSession,
    bootstrap: str,
    sink_bootstrap: str,
    main_topic: str,
    late_topic: str,
    topic: str = SOURCE_TOPIC,
    start: str | int = "latest",
    group_id: str | None = None,
    settings: Settings = Settings(),
    checkpoint: str | None = None,
    trigger_seconds: int = 10,
    source_options: dict | None = None,
    sink_options: dict | None = None,
    also: Sequence[Target] = (),
    also_late: Sequence[Target] = (),
    baseline: DataFrame | None = None,
    partition_groups: Sequence[Sequence[int]] | None = None,
):
    """``source_options`` go to the Kafka reader: security settings, and
    ``maxOffsetsPerTrigger`` to bound a batch (and a key's rows in it) when the
    job starts far behind.

    ``also`` and ``also_late``: further targets of the main and the late rows.
    ``baseline``: the last rows of a backfill, to start from.  ``partition_groups``: a
    watermark for each of these groups of source partitions, of which the lowest counts.
    What is left out is counted and logged by cause (``streaming.drops``).
    """
    jobs.use_rocksdb(spark)
    groups = partition_groups or [None]
    raws = [kafka_stream(spark, bootstrap, topic, start, group_id, source_options, g) for g in groups]
    counter = DropCounter("drops")
    spark.streams.addListener(counter)
    stream = jobs.change_log_stream(raws, settings, baseline, observe=counter.name)
    main, late = (kafka_target(sink_bootstrap, t, sink_options) for t in (main_topic, late_topic))
    writer = split_writer(fan_out(main, *also) if also else main, fan_out(late, *also_late) if also_late else late)
    return (
        stream.writeStream.foreachBatch(writer)
        .option("checkpointLocation", _checkpoint(spark, "change_log_app", checkpoint))
        .trigger(processingTime=f"{trigger_seconds} seconds")
        .queryName("device_change_log")
        .start()
    )


def start_snapshot_diff_app(
    spark: SparkSession,
    bootstrap: str,
    sink_bootstrap: str,
    sink_topic: str,
    topic: str = SOURCE_TOPIC,
    start: str | int = "latest",
    group_id: str | None = None,
    settings: Settings = Settings(idle_ttl_ms=PATH_B_IDLE_TTL_MS),
    bound_ms: int = PATH_B_BOUND_MS,
    checkpoint: str | None = None,
    trigger_seconds: int = 10,
    source_options: dict | None = None,
    sink_options: dict | None = None,
    also: Sequence[Target] = (),
    baseline: DataFrame | None = None,
):
    """Devices idle for 24 h are forgotten unless ``settings`` say otherwise.  ``also``: further
    targets, which take the batch that is computed once; ``baseline``: as for path A."""
    jobs.use_rocksdb(spark)
    raw = kafka_stream(spark, bootstrap, topic, start, group_id, source_options)
    diff = jobs.snapshot_diff_stream(raw, settings, bound_ms, baseline)
    if also:
        targets = (kafka_target(sink_bootstrap, sink_topic, sink_options, keyed=False), *also)
        return (
            diff.writeStream.foreachBatch(fan_out(*map(event_columns, targets)))
            .option("checkpointLocation", _checkpoint(spark, "snapshot_diff_app", checkpoint))
            .trigger(processingTime=f"{trigger_seconds} seconds")
            .queryName("device_snapshot_diff")
            .start()
        )
    records = as_kafka(table_event_records(diff), sink_topic).drop("topic")
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", sink_bootstrap)
        .option("topic", sink_topic)
        .options(**(sink_options or {}))
        .option("checkpointLocation", _checkpoint(spark, "snapshot_diff_app", checkpoint))
        .trigger(processingTime=f"{trigger_seconds} seconds")
        .queryName("device_snapshot_diff")
        .start()
    )


def change_log_backfill(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Path A over a bounded dump (no lateness: every row takes part)."""
    return changelog.change_log(parse.property_events(parse.snapshot_messages(raw), settings.linked), settings)


def snapshot_diff_backfill(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return snapshot.snapshot_diff(parse.snapshot_table(raw), settings).withColumnRenamed(
        "event_name", "eventName"
    ).withColumnRenamed("event_value", "eventValue").withColumnRenamed("event_ori_value", "eventOriValue")


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def arguments() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="devdelta")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name, bound in (("path-a", PATH_A_BOUND_MS), ("path-b", PATH_B_BOUND_MS)):
        p = sub.add_parser(name)
        p.add_argument("--bootstrap", required=True)
        p.add_argument("--sink-bootstrap", required=True)
        p.add_argument("--sink-topic", required=True)
        p.add_argument("--topic", default=SOURCE_TOPIC)
        p.add_argument("--start", default="latest")
        p.add_argument("--group-id")
        p.add_argument("--checkpoint")
        p.add_argument("--bound-ms", type=int, default=bound)
        p.add_argument("--trigger-seconds", type=int, default=10)
        p.add_argument("--max-offsets-per-trigger", type=int)
        p.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE")
        p.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE")
        p.add_argument("--also", action="append", default=[], metavar="SINK", help="a further sink (sinks.targets)")
        p.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE")
        p.add_argument("--slice-ms", type=int, default=Settings().slice_ms)
        if name == "path-a":
            p.add_argument("--late-topic", required=True)
            p.add_argument("--also-late", action="append", default=[], metavar="SINK")
            p.add_argument("--from-increments", metavar="PATH", help="start from the newest baseline of increment-a")
            p.add_argument("--partition-group", action="append", default=[], metavar="0,1,...", help="watermark of its own")
        else:
            p.add_argument("--idle-ttl-ms", type=int, default=PATH_B_IDLE_TTL_MS, help="0: devices are never forgotten")
            p.add_argument("--idle-clock", choices=["event", "processing"], default="event")
    for name in ("backfill-a", "backfill-b"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--format", default="parquet")
    p = sub.add_parser("increment-a")
    p.add_argument("--input", required=True)
    p.add_argument("--path", required=True)
    p.add_argument("--number", type=int, required=True, help="from 0; running a number again changes nothing")
    p.add_argument("--format", default="parquet")
    return ap


def _targets(sinks: list[str], args: argparse.Namespace, keyed: bool, part: str) -> list[Target]:
    options, properties = _options(args.sink_option), _options(args.jdbc_property)
    return [target_from(s, options, properties, keyed, writer=f"{args.cmd}-{part}") for s in sinks]


def start_from(spark: SparkSession, args: argparse.Namespace):
    """Start the streaming application that the arguments name."""
    source = _options(args.source_option)
    if args.max_offsets_per_trigger:
        source["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
    common = {
        "topic": args.topic,
        "start": int(args.start) if args.start.isdigit() else args.start,
        "group_id": args.group_id,
        "checkpoint": args.checkpoint,
        "trigger_seconds": args.trigger_seconds,
        "source_options": source,
        "sink_options": _options(args.sink_option),
    }
    common["also"] = _targets(args.also, args, args.cmd == "path-a", "main")
    if args.cmd == "path-a":
        settings = Settings(bound_ms=args.bound_ms, slice_ms=args.slice_ms)
        if args.from_increments:
            common["baseline"] = IncrementalChangeLog(args.from_increments, settings).newest_baseline(spark)
        if args.partition_group:
            common["partition_groups"] = [[int(n) for n in g.split(",")] for g in args.partition_group]
        common["also_late"] = _targets(args.also_late, args, True, "late")
        return start_change_log_app(
            spark, args.bootstrap, args.sink_bootstrap, args.sink_topic, args.late_topic, settings=settings, **common
        )
    settings = Settings(idle_ttl_ms=args.idle_ttl_ms or None, idle_clock=args.idle_clock, slice_ms=args.slice_ms)
    return start_snapshot_diff_app(
        spark, args.bootstrap, args.sink_bootstrap, args.sink_topic, settings=settings, bound_ms=args.bound_ms, **common
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"devdelta-{args.cmd}").getOrCreate()
    apply_cluster_defaults(spark)
    if args.cmd in ("path-a", "path-b"):
        start_from(spark, args).awaitTermination()
    elif args.cmd == "increment-a":
        IncrementalChangeLog(args.path).run(file_batch(spark, args.input, args.format), args.number)
    else:
        raw = file_batch(spark, args.input, args.format)
        out = change_log_backfill(raw) if args.cmd == "backfill-a" else snapshot_diff_backfill(raw)
        out.withColumn("_day", F.to_date(F.expr(timestamp_ms_sql("gmtCreate")))).write.mode("overwrite").partitionBy(
            "_day"
        ).parquet(args.output)


if __name__ == "__main__":
    main()
