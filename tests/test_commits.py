"""Committed tables: whole and once at every moment; increments and bucketed history."""

import os
import tempfile

import pytest
from conftest import message

from devdelta.operators import changelog, parse
from devdelta.plans.catalogue import CATALOGUE, messages, property_rows
from devdelta.plans.history import write_history
from devdelta.plans.increments import IncrementalChangeLog
from devdelta.sinks.commits import CommittedTable, Versions
from devdelta.sinks.targets import event_columns, target_from
from devdelta.sinks.writers import fan_out
from devdelta.sources.files import file_stream, kafka_rows
from devdelta.streaming.drops import DropCounter
from devdelta.streaming.jobs import change_log_stream, run_available

SF = "/root/testdata/sf0.001"
DDL = "x int, is_late boolean"


def folder(name):
    return tempfile.mkdtemp(prefix=f"run-{name}-", dir="/tmp") + "/t"


def rows(spark, *xs):
    return spark.createDataFrame([(x, x % 2 == 1) for x in xs], DDL)


def seen(spark, table):
    return sorted(tuple(r) for r in table.read(spark, DDL).collect())


def test_nothing_is_seen_before_the_commit_and_everything_once_after(spark):
    path = folder("commit")
    table = CommittedTable(path, partition_by=["is_late"])
    assert seen(spark, table) == []
    table(rows(spark, 1, 2), 0)
    cut = table.write_data(rows(spark, 3, 4), 1)  # killed here
    assert os.path.isdir(f"{path}/data/batch={cut}") and seen(spark, table) == [(1, True), (2, False)]
    again = CommittedTable(path, partition_by=["is_late"])  # the restarted job
    again(rows(spark, 1, 2), 0)  # ran to its end before: skipped
    again(rows(spark, 3, 4), 1)
    again(rows(spark, 3, 4), 1)
    assert seen(spark, again) == [(1, True), (2, False), (3, True), (4, False)]
    # a driver that was thought dead commits its copy of the batch after all
    table.commit(spark, 1, cut)
    assert seen(spark, again) == [(1, True), (2, False), (3, True), (4, False)]
    assert [b for _, b, _ in again.entries(spark)] == [0, 1]


def test_writers_count_their_batches_apart(spark):
    path = folder("writers")
    CommittedTable(path, "one")(rows(spark, 1), 0)
    CommittedTable(path, "two")(rows(spark, 2), 0)
    assert [r[0] for r in seen(spark, CommittedTable(path))] == [1, 2]


def test_empty_batches_and_versions(spark):
    table = CommittedTable(folder("empty"), partition_by=["is_late"])
    table(rows(spark, 1).limit(0), 0)
    assert seen(spark, table) == []
    table(rows(spark, 5), 1)
    assert seen(spark, table) == [(5, True)]
    versions = Versions(folder("versions"))
    versions.commit(rows(spark, 1, 2), 0)
    versions.commit(rows(spark, 3), 1)
    versions.commit(rows(spark, 9), 1)  # committed already
    assert [r.x for r in versions.read(spark, DDL, 1).collect()] == [3]
    assert versions.read(spark, DDL, 0).count() == 2 and versions.read(spark, DDL, 7).count() == 0


@pytest.mark.parametrize("cut_at", ["write_data", "commit", "after"])
def test_a_killed_batch_is_run_again(spark, cut_at):
    """The stream dies while writing, before the commit, or after it but before the checkpoint."""
    root = folder("killed")
    stream_rows = [[("T", "x", 100000)], [("T", "y", 120000)], [("Z", 0, 10_000_000)]]

    class Killed(CommittedTable):
        dead = False

        def die(self, where, do):
            if not self.dead and where == cut_at and where != "after":
                self.dead = True
                if where == "write_data":
                    do()
                raise InterruptedError(where)
            return do()

        def write_data(self, df, batch_id):
            return self.die("write_data", lambda: super(Killed, self).write_data(df, batch_id))

        def commit(self, spark, batch_id, name):
            self.die("commit", lambda: super(Killed, self).commit(spark, batch_id, name))
            if cut_at == "after" and not self.dead:
                self.dead = True
                raise InterruptedError("after")

    kafka_rows(spark, [message(i) for i in stream_rows]).coalesce(1).write.parquet(f"{root}/in")
    ddl = "eventName string, eventValue string, is_late boolean"
    first = Killed(f"{root}/out", partition_by=["is_late"])
    with pytest.raises(Exception, match="InterruptedError|STREAM_FAILED|FOREACH"):
        run_available(change_log_stream(file_stream(spark, f"{root}/in")), first, f"{root}/ckpt")
    assert first.dead and first.read(spark, ddl).count() == 0
    second = CommittedTable(f"{root}/out", partition_by=["is_late"])
    run_available(change_log_stream(file_stream(spark, f"{root}/in")), second, f"{root}/ckpt")
    assert sorted(r.eventValue for r in second.read(spark, ddl).collect()) == ["T:x", "T:y"]


def test_increments_equal_one_run_and_keep_late_rows_apart(spark):
    log = IncrementalChangeLog(folder("increments"))
    days = [
        [[("T", 1, 1000), ("U", 1, 1000)], [("T", 1, 2000)]],
        [[("T", 2, 3000)], [("T", 2, 1500)], [("U", 1, 3000)], [("V", 5, 3000)]],
        [[("T", 2, 4000), ("U", 3, 4000)]],
    ]
    with pytest.raises(ValueError):
        log.run(kafka_rows(spark, []), 1)
    off = 0
    for i, day in enumerate(days):
        raw = kafka_rows(spark, [message(m) for m in day], first_offset=off)
        off += len(day)
        log.run(raw, i)
        log.run(raw, i)  # again: nothing changes
    cols = ["eventName", "gmtCreate", "eventValue", "eventOriValue"]
    assert [tuple(r) for r in log.read(spark, late=True).select(*cols).collect()] == [("T", 1500, "T:2", "T:")]
    whole = kafka_rows(spark, [message(m) for day in days for m in day if m != [("T", 2, 1500)]])
    full = changelog.change_log(parse.property_events(parse.snapshot_messages(whole)))
    assert sorted(map(tuple, log.read(spark).select(*cols).collect())) == sorted(map(tuple, full.select(*cols).collect()))


def test_an_increment_cut_off_between_its_commits_is_run_again(spark):
    log = IncrementalChangeLog(folder("cut"))
    raw = kafka_rows(spark, [message([("T", 1, 1000)])])
    step = log.plan(raw, 0)
    log.changes(step.changes.selectExpr("*", "false as is_late"), 0)  # killed before the baseline
    log.run(raw, 0)
    assert log.read(spark).count() == 1 and log.newest_baseline(spark).count() == 1


def test_an_increment_reads_its_dump_and_the_baseline_only(spark):
    log = IncrementalChangeLog(folder("scans"))
    dumps = [folder("dump"), folder("dump")]
    for i, d in enumerate(dumps):
        kafka_rows(spark, [message([("T", i, 1000 + i)])], first_offset=i).write.parquet(d)
        if not i:
            log.run(spark.read.parquet(d), 0)
    step = log.plan(spark.read.parquet(dumps[1]), 1)
    files = step.changes.inputFiles()
    assert files and all(dumps[1] in f or "/baseline/" in f for f in files)


def test_bucketed_history_is_not_dealt_out_again(spark):
    table = write_history(property_rows(spark, SF), "history_test_" + folder("h").split("-")[-1].split("/")[0], 4)
    got = changelog.change_log(table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [p for p in plan.split("FileScan")[1:]]
    assert scans and all("Bucketed: true" in p for p in scans)
    # The one exchange left carries the boundary rows, by key.
    assert plan.count("Exchange") == 1 and "_first_in_bucket" in plan.split("Exchange")[1]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, CATALOGUE["change_log"](spark, SF).collect()))


def test_drop_counter_listens(spark):
    root = folder("drops")
    values = [message([("T", 1, 1000)]), "no json", message([("T", 1, 1)], drop=("iotId",)), message([("T", 1, 10**18)])]
    kafka_rows(spark, values).coalesce(1).write.parquet(f"{root}/in")
    counter = DropCounter("d")
    spark.streams.addListener(counter)
    try:
        query = run_available(change_log_stream(file_stream(spark, f"{root}/in"), observe="d"), lambda df, b: df.count(), f"{root}/ckpt")
        for _ in range(100):
            if any(b for _, b in counter.batches) or len(counter.batches) >= len(query.recentProgress):
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counter)
    assert {c: n for c, n in counter.totals().items() if n} == {"not_object": 1, "missing_field": 1, "bad_time": 1}


def test_sinks_by_name(spark, capfd):
    path = folder("sinks")
    df = spark.createDataFrame([("T", "i", "r", "{}", "P", 5, "d", "A", "A:1", "A:")], messages_ddl())
    spark.sql(f"CREATE TABLE sink_by_name_{path.split('-')[-1].split('/')[0]} ({messages_ddl()}) USING parquet LOCATION '{path}/cat'")
    name = f"sink_by_name_{path.split('-')[-1].split('/')[0]}"
    targets = [target_from(f"files:{path}/f"), target_from(f"table:{name}"), target_from("console:> ")]
    diff = df.withColumnsRenamed({"eventName": "event_name", "eventValue": "event_value", "eventOriValue": "event_ori_value"})
    fan_out(*map(event_columns, targets))(diff, 3)
    assert [tuple(r) for r in CommittedTable(f"{path}/f").read(spark, messages_ddl()).collect()] == [tuple(df.first())]
    assert [tuple(r) for r in spark.table(name).collect()] == [tuple(df.first())]
    for bad in ("kafka:host", "jdbc:url", "files:", "somewhere"):
        with pytest.raises(ValueError):
            target_from(bad)
    assert callable(target_from("kafka:h:9092/t")) and callable(target_from("jdbc:mysql://h/db#t"))


def messages_ddl():
    from devdelta.schema import CHANGE_EVENT_FIELDS

    return ", ".join(f"{n} {t.simpleString()}" for n, t in CHANGE_EVENT_FIELDS)


def test_an_increment_reads_its_dump_once(spark, tmp_path):
    log = IncrementalChangeLog(f"{tmp_path}/increments")
    texts = [message([("T", i // 2, 10 * i), ("U", i, 10 * i)], gmtCreate=10 * i) for i in range(6)]
    kafka_rows(spark, texts).write.parquet(f"{tmp_path}/dump")
    step = log.plan(spark.read.parquet(f"{tmp_path}/dump"), 0, f"{tmp_path}/staged")
    for rows in (step.changes, step.late, step.baseline):
        assert rows.inputFiles() and all("/staged/" in f for f in rows.inputFiles())
    plain = log.plan(kafka_rows(spark, texts), 0)
    for staged, own in ((step.changes, plain.changes), (step.late, plain.late), (step.baseline, plain.baseline)):
        assert sorted(map(str, staged.collect())) == sorted(map(str, own.collect()))
    assert step.changes.count() == 9 and step.baseline.count() == 2
