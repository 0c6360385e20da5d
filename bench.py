"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full (written to the ``noop`` sink): batch queries
once untimed and three times timed, of which the median counts; the replays of
streams, which start a job each time, once.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from devdelta.plans.catalogue import CATALOGUE  # noqa: E402
from devdelta.session import local_session  # noqa: E402
from devdelta.streaming.jobs import use_rocksdb  # noqa: E402

HEADLINE = [
    "parse_envelope",
    "explode_properties",
    "linked_group",
    "dedup_same_time",
    "first_seen",
    "change_log",
    "snapshot_lag",
    "snapshot_diff",
    "snapshot_diff_idle",
    "sink_rows",
    "snapshot_sink_rows",
    "sql_get_diff",
    "stream_change_log",
    "stream_late",
    "stream_snapshot_diff",
    "stream_snapshot_diff_idle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(
        cpus,
        app="devdelta-bench",
        extra={
            "spark.driver.memory": "16g",
            "spark.driver.extraJavaOptions": "-XX:ReservedCodeCacheSize=512m",
        },
    )
    use_rocksdb(spark)
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 if name.startswith("stream_") else 4):
            t0 = time.perf_counter()
            CATALOGUE[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs[-3:]), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
