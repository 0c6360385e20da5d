"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import staged


def connected(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node in ``links`` (a, b).

    Each round every node takes the smallest label among its neighbours' and
    its own, then the label of its label, until nothing changes; the rounds
    grow with the logarithm of the longest path.  Minima are pre-aggregated.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    edges = staged(both.distinct(), "edges")
    label = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    label = staged(label, "labels")
    while True:
        near = edges.join(label.select(F.col("node").alias("b"), F.col("label").alias("near")), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        taken = label.join(near, "node").select("node", F.least("label", "near").alias("next"), "label")
        up = label.select(F.col("node").alias("next"), F.col("label").alias("up"))
        new = taken.join(up, "next").select("node", F.least("next", "up").alias("new"), "label")
        new = staged(new, "labels")
        if new.where("new <> label").isEmpty():
            return new.select("node", F.col("new").alias("label"))
        label = new.select("node", F.col("new").alias("label"))
