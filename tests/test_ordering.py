"""The bucketed previous-row operator equals a plain per-key window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from devdelta.operators.ordering import FIRST, PREV, first_arrival, previous_in_key


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"
        rows.append((key, rnd.randint(0, 5000), rnd.randint(0, 3), i, f"v{rnd.randint(0, 4)}"))
    return spark.createDataFrame(rows, "k string, t long, partition int, offset long, v string")


def test_previous_in_key_matches_window(spark):
    df = _data(spark)
    for bucket in (7, 100, 10_000):
        got = previous_in_key(df, ["k"], "t", ["partition", "offset"], ["v"], bucket_ms=bucket)
        got = sorted((r.offset, r[FIRST], None if r[PREV] is None else r[PREV].v) for r in got.collect())
        w = Window.partitionBy("k").orderBy("t", "partition", "offset")
        ref = df.select("offset", (F.row_number().over(w) == 1).alias("f"), F.lag("v").over(w).alias("p"))
        assert got == sorted(tuple(r) for r in ref.collect()), bucket


def test_previous_in_key_dedup_same_time(spark):
    df = _data(spark, 2000, seed=3)
    got = previous_in_key(df, ["k"], "t", ["partition", "offset"], ["v", "offset"], bucket_ms=50, dedup_same_time=True)
    got = sorted((r.offset, None if r[PREV] is None else r[PREV].offset) for r in got.collect())
    w0 = Window.partitionBy("k", "t").orderBy("partition", "offset")
    kept = df.where(F.row_number().over(w0) == 1) if False else df.withColumn("rn", F.row_number().over(w0)).where("rn = 1")
    w = Window.partitionBy("k").orderBy("t")
    ref = kept.select("offset", F.lag("offset").over(w).alias("p"))
    assert got == sorted(tuple(r) for r in ref.collect())


def test_first_arrival(spark):
    df = _data(spark, 1000, seed=5)
    got = sorted(tuple(r) for r in first_arrival(df, ["k", "t"], ["partition", "offset"]).select("k", "t", "offset").collect())
    w = Window.partitionBy("k", "t").orderBy("partition", "offset")
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("k", "t", "offset")
    assert got == sorted(tuple(r) for r in ref.collect())
