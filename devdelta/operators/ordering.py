"""Event-time ordering per key: first-arrival de-duplication and the previous
row of a key (O1 O2 T5 W1 W2), built to survive hot keys.

A plain ``lag(...) OVER (PARTITION BY key ORDER BY t)`` sends all rows of a key
to one task; one busy device would then hold a large share of the data in a
single task.  Here the key's history is cut into event-time buckets:

1. rows are hash-partitioned on (key, bucket) and sorted by (t, arrival):
   repeated times are dropped (first arrival wins) and every row but the
   first of its bucket gets its previous row from ``lag`` in the bucket;
2. only the bucket boundary rows (first and last row of every bucket, at most
   two per key and bucket) are re-shuffled by key alone; ordered by time, the
   row before a bucket's first row is the last row of the previous non-empty
   bucket, so a ``lag`` over the boundary rows completes the answer;
3. the two halves are unioned -- no join.  Both halves keep every column, so
   they share one shuffle of the input (Spark reuses the exchange) and the
   input is read and parsed once.

The second shuffle carries at most ``2 x (time span / bucket_ms)`` rows per key,
however hot the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST = "_first"  # first row of its key
BUCKET = "_bucket"  # the time bucket; taken as it is where the rows have it (a table that is bucketed by it)
PREV = "_prev"  # struct of the carried columns of the previous row (NULL if first)


def bucket_of(time_col: str, bucket_ms: int) -> Column:
    return F.floor(F.col(time_col) / F.lit(bucket_ms)).cast("long")


def previous_in_key(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    ties: Sequence[str],
    carry: Sequence[str],
    bucket_ms: int,
    dedup_same_time: bool = False,
) -> DataFrame:
    """Add ``_first`` (bool) and ``_prev`` (struct of ``carry`` of the previous
    row of the same key in (time, ties) order).

    With ``dedup_same_time`` rows repeating a (key, time) are removed first,
    keeping the earliest by ``ties`` (arrival order).  Rows with a NULL time
    are not ordered and are dropped.  ``keys`` must be non-NULL columns.
    """
    keys = list(keys)
    cols = list(df.columns)
    part = keys + [BUCKET]
    order = [F.col(time_col)] + [F.col(c) for c in ties]
    rows = df.where(F.col(time_col).isNotNull())
    if BUCKET not in cols:
        rows = rows.withColumn(BUCKET, bucket_of(time_col, bucket_ms))
    w = Window.partitionBy(*part).orderBy(*order)
    if dedup_same_time:
        rows = rows.withColumn("_dup", F.coalesce(F.lag(time_col).over(w) == F.col(time_col), F.lit(False)))
        rows = rows.where(~F.col("_dup")).drop("_dup")
    # Carried columns are lagged one by one and assembled after the window: a
    # lagged struct would be built below the shuffle in one branch only.
    rows = rows.select(
        "*",
        *[F.lag(c).over(w).alias(f"_pb_{c}") for c in carry],
        F.lag(F.lit(True)).over(w).isNull().alias("_first_in_bucket"),
        F.lead(F.lit(True)).over(w).isNull().alias("_last_in_bucket"),
    )

    # ``_first`` is the (here always false) flag column rather than a literal:
    # a literal would let Catalyst prune columns from this branch only, and the
    # two branches would then no longer share the input shuffle.
    inner = rows.where(~F.col("_first_in_bucket")).select(
        *cols,
        F.col("_first_in_bucket").alias(FIRST),
        F.struct(*[F.col(f"_pb_{c}").alias(c) for c in carry]).alias(PREV),
    )
    wk = Window.partitionBy(*keys).orderBy(*order)
    boundary = rows.where(F.col("_first_in_bucket") | F.col("_last_in_bucket")).select(
        *cols,
        "_first_in_bucket",
        F.lag(F.lit(True)).over(wk).isNull().alias("_no_prev"),
        *[F.lag(c).over(wk).alias(f"_pk_{c}") for c in carry],
    )
    heads = boundary.where(F.col("_first_in_bucket")).select(
        *cols,
        F.col("_no_prev").alias(FIRST),
        F.when(~F.col("_no_prev"), F.struct(*[F.col(f"_pk_{c}").alias(c) for c in carry])).alias(PREV),
    )
    return inner.unionByName(heads)


def first_arrival(df: DataFrame, group: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """One row per ``group``: the earliest by ``ties`` (O2/T5 without order).

    ``min_by`` is partially aggregated before the shuffle, so a hot group costs
    one small partial row per input partition.
    """
    group = list(group)
    payload = [c for c in df.columns if c not in group]
    best = F.min_by(F.struct(*[F.col(c) for c in payload]), F.struct(*[F.col(c) for c in ties]))
    return df.groupBy(*group).agg(best.alias("_best")).select(*group, *[F.col("_best")[c].alias(c) for c in payload])
