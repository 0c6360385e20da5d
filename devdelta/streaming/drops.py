"""Counts of what a job leaves out, by cause (S1 P2 and the error rules of the ingestion).

The ingestion observes its drops in the same pass (``operators.parse``); Spark
hands the counts of every micro-batch to the query's progress.  ``DropCounter``
is a listener that collects and logs them; ``add`` takes a progress directly.  A
batch that is run again replaces its earlier counts.

Causes: ``bad_key`` (the record key is no JSON, which loses the value),
``not_object`` (no JSON object, or no value), ``missing_field`` (one of the seven
envelope fields), ``no_items`` (items null, no object or empty),
``property_not_object``, ``property_incomplete`` (without value or time),
``bad_time`` (a time that no timestamp holds; such rows go to the late output).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from devdelta.operators.parse import MESSAGE_CAUSES, PROPERTY_CAUSES

CAUSES = (*MESSAGE_CAUSES, *PROPERTY_CAUSES, "bad_time")
log = logging.getLogger(__name__)


class DropCounter(StreamingQueryListener):
    """``spark.streams.addListener(DropCounter("drops"))``; the name is the one given to ``observe``."""

    def __init__(self, name: str = "drops"):
        self.name = name
        self.batches: dict[tuple[str, int], dict[str, int]] = {}

    def add(self, progress) -> None:
        counts: dict[str, int] = {}
        for metric, row in progress.observedMetrics.items():
            if metric.startswith(self.name + "_"):
                for cause, n in row.asDict().items():
                    counts[cause] = counts.get(cause, 0) + (n or 0)
        if not counts:
            return
        self.batches[str(progress.id), progress.batchId] = counts
        dropped = {c: n for c, n in counts.items() if c in CAUSES and n}
        if dropped:
            log.warning("query %s, batch %s: left out %s", progress.name or progress.id, progress.batchId, dropped)

    def totals(self) -> dict[str, int]:
        """Rows or properties left out so far, for each cause."""
        return {c: sum(b.get(c, 0) for b in self.batches.values()) for c in CAUSES}

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.totals().items()), "cause string, n long")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
