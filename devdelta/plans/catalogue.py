"""The query catalogue: name -> (spark, sf_dir) -> DataFrame.

Every query reads the test tables (``events``) and runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from devdelta.config import DAY_MS, ENVELOPE_TEXT_FIELDS, PATH_B_IDLE_TTL_MS, SOURCE_TOPIC, Settings, watermark_delay_ms
from devdelta.operators import changelog, parse, snapshot
from devdelta.plans.history import write_history
from devdelta.plans.increments import EVENT_DDL, IncrementalChangeLog
from devdelta.plans.views import (
    create_sink_table,
    insert_statement,
    lateral_statement,
    register_diff_table_function,
    register_sql_views,
    store_lag_view,
)
from devdelta.schema import CHANGE_EVENT_COLUMNS
from devdelta.session import scratch_path
from devdelta.sinks.commits import CommittedTable, Versions
from devdelta.sinks.records import keyed_event_records, table_event_records
from devdelta.sources.files import file_stream
from devdelta.sources.fixtures import (
    N_PARTITIONS,
    drop_messages,
    edge_messages,
    event_rows,
    fixture_messages,
    raw_property_events,
    timed_messages,
)
from devdelta.streaming import jobs
from devdelta.streaming.drops import DropCounter
from devdelta.streaming.jobs import use_rocksdb

Query = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def messages(spark: SparkSession, sf_dir: str, days: Column | None = None) -> DataFrame:
    """Kafka-shaped snapshot messages derived from ``events``; with ``days``, a condition on ``_day()``,
    those of such days: a message is of one day, so the other days' events need not be grouped for it."""
    rows = events(spark, sf_dir)
    return fixture_messages(rows if days is None else rows.where(days))


def property_rows(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> DataFrame:
    return parse.property_events(parse.snapshot_messages(messages(spark, sf_dir)), settings.linked)


def q_parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = parse.snapshot_messages(messages(spark, sf_dir))
    return m.select(
        "deviceType",
        "iotId",
        "requestId",
        "checkFailedData",
        "productKey",
        "deviceName",
        "offset",
        F.array_join(F.map_keys("items"), ",").alias("item_names"),
    )


def q_explode_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = parse.snapshot_messages(messages(spark, sf_dir))
    return parse.plain_properties(m).select(*CHANGE_EVENT_COLUMNS)


def q_linked_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = parse.snapshot_messages(messages(spark, sf_dir))
    return parse.linked_properties(m).select(*CHANGE_EVENT_COLUMNS)


def q_dedup_same_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_property_events(events(spark, sf_dir), truncate_to_day=True)
    return changelog.dedup_same_time(rows).select(*CHANGE_EVENT_COLUMNS, "offset")


def q_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.first_seen(property_rows(spark, sf_dir))


def q_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.change_log(property_rows(spark, sf_dir))


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.snapshot_table(messages(spark, sf_dir))


def q_snapshot_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lag = snapshot.snapshot_lag(snapshot_rows(spark, sf_dir))
    return lag.select(*snapshot.ENVELOPE, "newData", "oldData")


def q_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.snapshot_diff(snapshot_rows(spark, sf_dir))


def q_snapshot_diff_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path B with the 24 h idle expiry: a device silent for longer than that
    is diffed as if seen for the first time."""
    return snapshot.snapshot_diff(snapshot_rows(spark, sf_dir), Settings(idle_ttl_ms=PATH_B_IDLE_TTL_MS))


def q_sink_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_event_records(q_change_log(spark, sf_dir))


def q_snapshot_sink_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_event_records(q_snapshot_diff(spark, sf_dir)).select("value")


FLUSH_AFTER_MS = 2 * PATH_B_IDLE_TTL_MS


def flush_message(spark: SparkSession, at_ms: int) -> DataFrame:
    """A message of a device of its own whose time moves the watermark past all
    others, so that a bounded replay releases every row; it stays pending itself."""
    envelope = ", ".join(f"'{f}', 'flush'" for f in ENVELOPE_TEXT_FIELDS)
    item = f"map('Flush', named_struct('value', 0, 'time', {int(at_ms)}L))"
    return spark.range(1).selectExpr(
        "CAST('\"flush\"' AS BINARY) AS key",
        f"CAST(to_json(named_struct({envelope}, 'gmtCreate', {int(at_ms)}L, 'items', {item})) AS BINARY) AS value",
        f"'{SOURCE_TOPIC}' AS topic",
        "0 AS partition",
        f"{int(at_ms)}L AS offset",
        f"timestamp_millis({int(at_ms)}L) AS timestamp",
    )


def _day() -> Column:
    """Epoch day of an event, and so of its message; zone-independent."""
    return F.datediff(F.col("ts").cast("timestamp_ntz").cast("date"), F.lit("1970-01-01").cast("date"))


def _day_bounds(spark: SparkSession, sf_dir: str) -> tuple[int, int, int]:
    """First, last and middle day.  Message days are the days of the events: a one-column
    aggregate over the table (a single small row), not over the messages."""
    bounds = events(spark, sf_dir).agg(F.min(_day()).alias("lo"), F.max(_day()).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    return lo, hi, lo + (hi - lo) // 2


def _phased_replay(spark: SparkSession, sf_dir: str, late_half_first: bool, name: str) -> tuple[str, list[DataFrame]]:
    """Write the derived messages as two replay phases (two file drops) in a
    fresh folder under the shared checkpoint root; phase order by day."""
    lo, hi, mid = _day_bounds(spark, sf_dir)
    early, late = messages(spark, sf_dir, _day() < mid), messages(spark, sf_dir, _day() >= mid)
    if late_half_first:
        phases = [late, early]
    else:
        # In the last drop: it moves the watermark for the batch after, which releases all.
        phases = [early, late.unionByName(flush_message(spark, (hi + 1) * DAY_MS + FLUSH_AFTER_MS))]
    return scratch_path(spark, name), phases


#: Of a replay, events for one state partition: a worker holds all that its partition releases in a batch.
PARTITION_EVENTS = 250_000


def _run_phases(spark: SparkSession, sf_dir: str, root: str, phases: list[DataFrame], build, writer) -> None:
    """Drop each phase into the input folder and let the job catch up.

    A new checkpoint fixes its state partitions from ``spark.sql.shuffle.partitions``;
    for these bounded replays that is set to the cluster's default parallelism, or
    more by the size of the input, for the runs (and restored afterwards), not to a large batch default.
    """
    with _replay_session(spark, sf_dir):
        for phase in phases:
            phase.write.mode("append").parquet(f"{root}/in")
            jobs.run_available(build(file_stream(spark, f"{root}/in")), writer, f"{root}/checkpoint")


@contextmanager
def _replay_session(spark: SparkSession, sf_dir: str):
    use_rocksdb(spark)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(spark.sparkContext.defaultParallelism, -(-events(spark, sf_dir).count() // PARTITION_EVENTS))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


DIFF_DDL = (
    "deviceType string, iotId string, requestId string, checkFailedData string, productKey string, "
    "gmtCreate bigint, deviceName string, event_name string, event_value string, event_ori_value string"
)


#: In a replay all rows of a phase wait for its last one: slices as long as their history.
#: Their batches touch every key, so the keys go in slots.
REPLAY = Settings(slice_ms=400 * DAY_MS, key_slots=1 << 12)
REPLAY_IDLE = replace(REPLAY, idle_ttl_ms=PATH_B_IDLE_TTL_MS)


def _changes(spark: SparkSession, table: CommittedTable, late: bool = False) -> DataFrame:
    return table.read(spark, f"{EVENT_DDL}, is_late boolean").where(F.col("is_late") == F.lit(late)).select(*CHANGE_EVENT_COLUMNS)


def _diffs(spark: SparkSession, table: CommittedTable) -> DataFrame:
    return table.read(spark, DIFF_DDL).select(*snapshot.ENVELOPE, "event_name", "event_value", "event_ori_value")


def _change_table(root: str) -> CommittedTable:
    """Main and late rows of a replay, committed together."""
    return CommittedTable(f"{root}/changes", partition_by=["is_late"])


def q_stream_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, phases = _phased_replay(spark, sf_dir, False, "stream_change_log")
    table = _change_table(root)
    _run_phases(spark, sf_dir, root, phases, lambda raw: jobs.change_log_stream(raw, REPLAY), table)
    return _changes(spark, table)


def _last_ms(spark: SparkSession, sf_dir: str, where: Column) -> int:
    """The latest property time of the messages in question: the latest of their events."""
    rows = event_rows(events(spark, sf_dir))
    return rows.where(where).agg(F.max("ms")).first()[0]


def _event_day() -> Column:
    return F.datediff(F.col("day"), F.lit("1970-01-01").cast("date"))


def q_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late rows when the later half comes first: the earlier half, and of rows
    timed just below, at and just above the watermark the first two thirds."""
    root, phases = _phased_replay(spark, sf_dir, True, "stream_late")
    _, _, mid = _day_bounds(spark, sf_dir)
    watermark = _last_ms(spark, sf_dir, _event_day() >= mid) - watermark_delay_ms(REPLAY.bound_ms)
    phases[1] = phases[1].unionByName(timed_messages(events(spark, sf_dir), watermark))
    table = _change_table(root)
    _run_phases(spark, sf_dir, root, phases, lambda raw: jobs.change_log_stream(raw, REPLAY), table)
    return _changes(spark, table, late=True)


def q_stream_min_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late rows of a job over two groups of source partitions, of which one lags behind.

    First the fast group's later half and the slow group's second quarter arrive, then all the rest.
    The watermark is the slow group's, so its own later half is not late though the fast group is far ahead.
    """
    root = scratch_path(spark, "stream_min_watermark")
    lo, hi, mid = _day_bounds(spark, sf_dir)
    quarter = lo + (hi - lo) // 4
    fast, slow = F.col("partition") < N_PARTITIONS // 2, F.col("partition") >= N_PARTITIONS // 2
    second = (_day() >= quarter) & (_day() < mid)
    of = lambda group, days: messages(spark, sf_dir, days).where(group)
    phases = [(of(fast, _day() >= mid), of(slow, second)), (of(fast, _day() < mid), of(slow, ~second))]
    table = _change_table(root)
    with _replay_session(spark, sf_dir):
        for phase in phases:
            for i, rows in enumerate(phase):
                rows.write.mode("append").parquet(f"{root}/in{i}")
            raws = [file_stream(spark, f"{root}/in{i}") for i in range(len(phase))]
            jobs.run_available(jobs.change_log_stream(raws, REPLAY), table, f"{root}/checkpoint")
    return _changes(spark, table, late=True)


def q_stream_from_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier half as a batch, the later half as a stream that starts from the batch's last rows."""
    root, (early, late) = _phased_replay(spark, sf_dir, False, "stream_from_backfill")
    history = parse.property_events(parse.snapshot_messages(early))
    versions = Versions(f"{root}/baseline")
    versions.commit(changelog.baseline(history), 0)
    baseline = versions.read(spark, f"{', '.join(f'{k} string' for k in changelog.KEYS)}, t long, value string", 0)
    table = _change_table(root)
    _run_phases(spark, sf_dir, root, [late], lambda raw: jobs.change_log_stream(raw, REPLAY, baseline), table)
    return changelog.change_log(history).unionByName(_changes(spark, table))


def q_stream_snapshots_from_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for path B."""
    root, (early, late) = _phased_replay(spark, sf_dir, False, "stream_snapshots_from_backfill")
    history = parse.snapshot_table(early)
    versions = Versions(f"{root}/baseline")
    versions.commit(snapshot.baseline(history), 0)
    baseline = versions.read(spark, f"{', '.join(f'{k} string' for k in snapshot.DEVICE_KEYS)}, t long, value string", 0)
    table = CommittedTable(f"{root}/diff")
    _run_phases(spark, sf_dir, root, [late], lambda raw: jobs.snapshot_diff_stream(raw, REPLAY, baseline=baseline), table)
    return snapshot.snapshot_diff(history).unionByName(_diffs(spark, table))


class _CutOff(CommittedTable):
    """Fails once after the rows of a batch are written, before they are committed."""

    cut = False

    def commit(self, spark: SparkSession, batch_id: int, folder: str) -> None:
        if not self.cut:
            self.cut = True
            raise InterruptedError("cut off before the commit")
        super().commit(spark, batch_id, folder)


def q_stream_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay whose first batch is cut off after its files are written, and run again: every row once."""
    root, phases = _phased_replay(spark, sf_dir, False, "stream_committed")
    table = _CutOff(f"{root}/changes", partition_by=["is_late"])
    build = lambda raw: jobs.change_log_stream(raw, REPLAY)
    try:
        _run_phases(spark, sf_dir, root, phases[:1], build, table)
    except StreamingQueryException:
        if not table.cut:
            raise
    again = _change_table(root)
    _run_phases(spark, sf_dir, root, phases[1:], build, again)
    return _changes(spark, again)


def q_stream_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream over faulty messages left out, by cause, from the counts that it observes itself."""
    root = scratch_path(spark, "stream_drop_counts")
    counter = DropCounter("drops")
    drop_messages(events(spark, sf_dir)).write.parquet(f"{root}/in")
    with _replay_session(spark, sf_dir):
        stream = jobs.change_log_stream(file_stream(spark, f"{root}/in"), REPLAY, observe=counter.name)
        query = jobs.run_available(stream, _change_table(root), f"{root}/checkpoint")
    for progress in query.recentProgress:
        counter.add(progress)
    return counter.frame(spark)


def q_gate_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path A over the same faulty messages."""
    return changelog.change_log(parse.property_events(parse.snapshot_messages(drop_messages(events(spark, sf_dir)))))


def q_incremental_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log in three increments, each from its own days and the baseline before."""
    log = IncrementalChangeLog(scratch_path(spark, "increments"))
    lo, hi, _ = _day_bounds(spark, sf_dir)
    cuts = [lo, lo + (hi - lo) // 3, lo + 2 * (hi - lo) // 3, hi + 1]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        log.run(messages(spark, sf_dir, (_day() >= a) & (_day() < b)), i)
    return log.read(spark)


def q_bucketed_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log from a history table that is bucketed by its keys."""
    path = scratch_path(spark, "history")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    return changelog.change_log(write_history(property_rows(spark, sf_dir), name, 8, path=path))


def q_stream_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, phases = _phased_replay(spark, sf_dir, False, "stream_snapshot_diff")
    table = CommittedTable(f"{root}/diff")
    _run_phases(spark, sf_dir, root, phases, lambda raw: jobs.snapshot_diff_stream(raw, REPLAY), table)
    return _diffs(spark, table)


def q_stream_snapshot_diff_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_snapshot_diff`` with the 24 h idle expiry."""
    root, phases = _phased_replay(spark, sf_dir, False, "stream_snapshot_diff_idle")
    table = CommittedTable(f"{root}/diff")
    _run_phases(spark, sf_dir, root, phases, lambda raw: jobs.snapshot_diff_stream(raw, REPLAY_IDLE), table)
    return _diffs(spark, table)


def q_sql_get_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path B through its SQL surface: table and views of texts, ``getDiff(STRING, STRING)``."""
    return register_sql_views(spark, messages(spark, sf_dir))


def q_sql_insert_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path B as a SQL job: table, views, sink table and ``INSERT INTO`` by position."""
    register_sql_views(spark, messages(spark, sf_dir))
    path = scratch_path(spark, "sink_table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    create_sink_table(spark, name, path)
    spark.sql(insert_statement(name))
    return spark.table(name)


def q_sql_lateral_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path B's second view with the diff as a table function joined laterally."""
    register_sql_views(spark, messages(spark, sf_dir))
    store_lag_view(spark, scratch_path(spark, "lag_view"))
    register_diff_table_function(spark)
    return spark.sql(lateral_statement())


def q_edge_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path A over irregular messages: what is skipped, rendered, compared and tied."""
    messages = parse.snapshot_messages(edge_messages(events(spark, sf_dir)))
    return changelog.change_log(parse.property_events(messages))


def q_edge_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path B over the same messages."""
    return snapshot.snapshot_diff(parse.snapshot_table(edge_messages(events(spark, sf_dir))))


CATALOGUE: dict[str, Query] = {
    "parse_envelope": q_parse_envelope,
    "explode_properties": q_explode_properties,
    "linked_group": q_linked_group,
    "dedup_same_time": q_dedup_same_time,
    "first_seen": q_first_seen,
    "change_log": q_change_log,
    "snapshot_lag": q_snapshot_lag,
    "snapshot_diff": q_snapshot_diff,
    "snapshot_diff_idle": q_snapshot_diff_idle,
    "sink_rows": q_sink_rows,
    "snapshot_sink_rows": q_snapshot_sink_rows,
    "stream_change_log": q_stream_change_log,
    "stream_late": q_stream_late,
    "stream_snapshot_diff": q_stream_snapshot_diff,
    "stream_snapshot_diff_idle": q_stream_snapshot_diff_idle,
    "stream_from_backfill": q_stream_from_backfill,
    "stream_snapshots_from_backfill": q_stream_snapshots_from_backfill,
    "stream_committed": q_stream_committed,
    "stream_min_watermark": q_stream_min_watermark,
    "stream_drop_counts": q_stream_drop_counts,
    "gate_change_log": q_gate_change_log,
    "incremental_change_log": q_incremental_change_log,
    "bucketed_change_log": q_bucketed_change_log,
    "sql_get_diff": q_sql_get_diff,
    "sql_lateral_diff": q_sql_lateral_diff,
    "sql_insert_into": q_sql_insert_into,
    "edge_change_log": q_edge_change_log,
    "edge_snapshot_diff": q_edge_snapshot_diff,
}
