"""Property history bucketed by its key (R1): change logs without dealing it out again.

The history is written once into a table that is bucketed by the key columns and
the time bucket of ``operators.ordering`` and sorted inside.  The windows of the
change log, which need the rows of one key and bucket together, then read it as it
lies; only the first and last rows of each key and bucket are still shuffled.
Bucketing by the time bucket, too, keeps a hot key's history in many files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from devdelta.config import Settings
from devdelta.operators import changelog
from devdelta.operators.ordering import BUCKET, bucket_of
from devdelta.operators.parse import ARRIVAL


def write_history(events: DataFrame, table: str, buckets: int, settings: Settings = Settings(), path: str | None = None) -> DataFrame:
    """Write property events as the catalog table ``table`` (at ``path`` if given) and return it.

    Choose ``buckets`` so that one fits a task; rows without a time have no place in a history.
    """
    keys = changelog.key_names(settings)
    extra = [k for k in changelog.key_exprs(settings)] if not set(keys) <= set(events.columns) else []
    rows = events.where("gmtCreate is not null").select("*", *extra, bucket_of("gmtCreate", settings.lag_bucket_ms).alias(BUCKET))
    part = [*keys, BUCKET]
    # Dealt by the same hash first: every bucket is one file.
    writer = rows.repartition(buckets, *part).write.format("parquet").bucketBy(buckets, *part).sortBy(*part, "gmtCreate", *ARRIVAL)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return events.sparkSession.table(table)
