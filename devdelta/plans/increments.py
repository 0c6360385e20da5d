"""Path A over dumps that come one after the other (T8, W1), without reading the history again.

An increment compares a new dump with the baseline of the one before: one row a
key, the last.  Its changes and the baseline after it are committed under
the increment's number (``sinks.commits``), so readers see each increment whole
and once, and an increment that was cut off is simply run again: what it committed
stays, the rest is worked out anew from the same baseline.  Rows that are not
newer than their key's baseline came too late and are kept apart.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdelta.config import Settings
from devdelta.operators import changelog, parse
from devdelta.schema import CHANGE_EVENT_COLUMNS, CHANGE_EVENT_FIELDS
from devdelta.sinks.commits import CommittedTable, Versions

EVENT_DDL = ", ".join(f"{n} {t.simpleString()}" for n, t in CHANGE_EVENT_FIELDS)


@dataclass
class Increment:
    changes: DataFrame
    late: DataFrame
    baseline: DataFrame


class IncrementalChangeLog:
    """The change log under ``path``: changes, late rows and the baselines between increments."""

    def __init__(self, path: str, settings: Settings = Settings()):
        self.settings, self.path = settings, path
        self.changes = CommittedTable(f"{path}/changes", "increments", ["is_late"])
        self.baselines = Versions(f"{path}/baseline")
        keys = changelog.key_names(settings)
        self.baseline_ddl = ", ".join(f"{k} string" for k in keys) + ", t long, value string"

    def plan(self, raw: DataFrame, number: int, staged: str | None = None) -> Increment:
        """What increment ``number`` (from 0) makes of a dump; reads the dump and the baseline before it only.

        With ``staged``, a new folder, the parsed rows and their baselines are written there first: the
        increment reads them four times (changes within and between time buckets, late rows, next baseline), the dump once.
        """
        spark = raw.sparkSession
        last = self.baselines.read(spark, self.baseline_ddl, number - 1)
        events = parse.property_events(parse.snapshot_messages(raw), self.settings.linked)
        joined = changelog.join_baseline(events, last, self.settings)
        if staged:
            joined.write.parquet(staged)
            joined = spark.read.schema(joined.schema).parquet(staged)
        fresh, late = changelog.by_baseline(joined)
        return Increment(
            changelog.change_log(fresh, self.settings),
            late.select(*CHANGE_EVENT_COLUMNS),
            changelog.later_baseline(last, fresh, self.settings),
        )

    def run(self, raw: DataFrame, number: int) -> None:
        """Run and commit an increment; one that is committed already is left as it is."""
        spark = raw.sparkSession
        if number and number - 1 not in self.baselines.numbers(spark):
            raise ValueError(f"increment {number - 1} has not been run")
        step = self.plan(raw, number, f"{self.path}/staged/{number}-{uuid.uuid4().hex}")
        flag = lambda df, late: df.withColumn("is_late", F.lit(late))
        self.changes.done = None  # looked up again: other processes may have gone on
        self.changes(flag(step.changes, False).unionByName(flag(step.late, True)), number)
        self.baselines.commit(step.baseline, number)

    def newest_baseline(self, spark: SparkSession) -> DataFrame:
        """The last row of every key, to start a stream from (``jobs.change_log_stream``)."""
        return self.baselines.read(spark, self.baseline_ddl, max(self.baselines.numbers(spark), default=-1))

    def read(self, spark: SparkSession, late: bool = False) -> DataFrame:
        rows = self.changes.read(spark, f"{EVENT_DDL}, is_late boolean")
        return rows.where(F.col("is_late") == F.lit(late)).select(*CHANGE_EVENT_COLUMNS)
