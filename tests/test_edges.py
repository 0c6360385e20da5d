"""Edge rules: nothing is lost around a bad property, record or time; sinks write all rows."""

import json

import pytest
from conftest import message
from pyspark.sql import functions as F

from devdelta.config import LEGACY_OLD_GROUP, PATH_B_IDLE_TTL_MS
from devdelta.functions.diff import get_diff_sql
from devdelta.operators import parse, snapshot
from devdelta.plans import apps
from devdelta.session import checkpoint_root
from devdelta.sinks.writers import console_target, jdbc_rows, kafka_records
from devdelta.sources.files import kafka_rows
from devdelta.streaming.lag_processor import INPUT_COLUMNS as lag_columns
from devdelta.streaming.lag_processor import SnapshotLagProcessor
from state_fakes import batch, rows_of, started


def with_items(items, **env):
    head = json.loads(message([("T", 1, 1)], **env))
    head.pop("items")
    return json.dumps(head)[:-1] + ',"items":' + items + "}"


def test_only_the_bad_property_is_left_out(spark):
    bad = ['{"Light":5,"Other":{"value":1,"time":2}}', '{"Other":{"value":1,"time":2},"Light":[1]}', '{"Light":5}', '"{}"', "7", "null"]
    raw = kafka_rows(spark, [with_items(x) for x in bad])
    rows = parse.property_events(parse.snapshot_messages(raw)).collect()
    assert [(r.offset, r.eventValue) for r in rows] == [(0, "Other:1"), (1, "Other:1")]
    assert {r.eventName: r.skipped for r in parse.skipped_properties(raw).collect()} == {"Light": 3}
    first = kafka_rows(spark, [with_items(bad[0])])
    assert [r.event_value for r in snapshot.snapshot_diff(parse.snapshot_table(first)).collect()] == ["ErrorCode:0"]


def test_times_beyond_timestamps_keep_their_rows(spark):
    late = 1_680_278_400_000_000_000
    raw = kafka_rows(spark, [with_items(f'{{"T":{{"value":1,"time":{late}}}}}', gmtCreate=late)])
    assert parse.property_events(parse.snapshot_messages(raw)).first().gmtCreate == late
    row = parse.snapshot_table(raw).first()
    assert row.gmtCreate == late and row.ts_ltz is None


def test_table_drops_what_is_no_object(spark):
    raw = kafka_rows(spark, ["not json", "[1]", '{"deviceType":"T"', None, '{"other":1}', with_items("{}")])
    rows = parse.snapshot_table(raw).collect()
    assert sorted(r.offset for r in rows) == [4, 5] and dict(parse.snapshot_table(raw).dtypes)["items"] == "string"


def test_number_text_and_items_in_a_string(spark):
    texts = ['{"T":{"value":3.0}}', '{"T":{"value":3}}', '"{\\"T\\":{\\"value\\":4}}"']
    raw = kafka_rows(spark, [with_items(t, gmtCreate=i) for i, t in enumerate(texts)])
    rows = snapshot.snapshot_diff(parse.snapshot_table(raw)).where("gmtCreate > 0").orderBy("gmtCreate").collect()
    assert [(r.event_value, r.event_ori_value) for r in rows] == [("T:3", "T:3.0"), ("T:4", "T:3")]


def test_old_group_names_must_be_linked():
    with pytest.raises(ValueError, match="outside"):
        get_diff_sql("n", "o", linked=("A", "B"), old_linked=LEGACY_OLD_GROUP)


def test_console_prints_every_row(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(25).repartition(3)

    class Counted:
        columns = rows.columns

        def select(self, col):
            text = rows.select(col)

            class Each:
                @staticmethod
                def foreachPartition(show):
                    def run(it):
                        held = list(it)
                        seen.add(len(held))
                        show(iter(held))

                    text.foreachPartition(run)

            return Each

    console_target("p ")(Counted(), 0)
    assert seen.value == 25


def test_records_carry_the_batch_id(spark):
    df = spark.createDataFrame(
        [("T", "i", "r", "c", "P", 1, "d", "N", "N:1", "N:")],
        "deviceType string, iotId string, requestId string, checkFailedData string, productKey string, "
        "gmtCreate long, deviceName string, eventName string, eventValue string, eventOriValue string",
    ).withColumn("extra", F.lit(1))
    r = kafka_records(df, "t", 7).first()
    assert [(h.key, bytes(h.value)) for h in r.headers] == [("batch_id", b"7")] and r.topic == "t"
    rows = jdbc_rows(df, 7)
    assert rows.columns[-1] == "batch_id" and len(rows.columns) == 11 and rows.first().batch_id == 7


def test_one_expiry_timer_per_device():
    p = SnapshotLagProcessor(1000, PATH_B_IDLE_TTL_MS)
    handle = started(p)
    released = 0
    for t in range(1, 1001):
        released += len(batch(p, handle, t - 1, rows_of(lag_columns, [(t, 0, t, *["x"] * 6, "{}")])))
    released += len(batch(p, handle, 1000))
    assert released == 1000 and handle.timers == {1000 + PATH_B_IDLE_TTL_MS}


def test_cluster_without_a_checkpoint_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Conf())

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Fake())


def test_arguments_reach_the_applications(monkeypatch):
    got = {}
    for name in ("start_change_log_app", "start_snapshot_diff_app"):
        monkeypatch.setattr(apps, name, lambda *a, n=name, **k: got.update({n: (a[1:], k)}))
    common = ["--bootstrap", "b:1", "--sink-bootstrap", "s:1", "--sink-topic", "out", "--max-offsets-per-trigger", "9"]
    common += ["--source-option", "kafka.security.protocol=SSL", "--sink-option", "kafka.acks=all", "--bound-ms", "1000", "--start", "5"]
    apps.start_from(None, apps.arguments().parse_args(["path-a", *common, "--late-topic", "late"]))
    apps.start_from(None, apps.arguments().parse_args(["path-b", *common]))
    args, kw = got["start_change_log_app"]
    assert args == ("b:1", "s:1", "out", "late") and kw["settings"].bound_ms == 1000 and kw["start"] == 5
    assert kw["source_options"] == {"kafka.security.protocol": "SSL", "maxOffsetsPerTrigger": "9"}
    args, kw = got["start_snapshot_diff_app"]
    assert args == ("b:1", "s:1", "out") and kw["settings"].idle_ttl_ms == PATH_B_IDLE_TTL_MS and kw["bound_ms"] == 1000
    assert kw["sink_options"] == {"kafka.acks": "all"}
