"""Mixing sources to target weights by hierarchical budgeting.

A tree of domains, their languages and their sources gets a token budget.
Weights (equal where none is given) are normalised among siblings and
propagated from the root: a node's budget is split over its children.  A child
that can't use its share (it holds fewer tokens than that in all its epochs)
gives the rest to its siblings, in proportion to their weights, until all are
full or nothing is left; only what no sibling can take goes up to the parent,
which offers it to its own siblings in the same way.

The tree has one row per (domain, language, source) and comes from a
pre-aggregated count, however many there are, and is worked out level by level in
Spark: siblings fill up in the order of capacity over weight, so sums over a
parent's distinct values of that ratio tell which are full and what the others
get for each unit of weight.

Each leaf takes a prefix, in tokens, of its documents.  Every epoch has its own
order, seeded: by a hash of seed, epoch and document.  Epochs before the last
are taken whole; of the last, the documents up to the first that the budget
doesn't pay for whole: less than its tokens stay unspent, and no sibling gets them.
Prefix sums are made in two steps (sums of hash-ordered buckets, then
sums inside the one bucket where the budget ends), so a source that holds a
third of all rows is never ordered by one task.

A document's tokens are its words between white space (one at least, so empty
texts cost something).  Null domain, language or source: a node of its own,
named ''.  Repeated ids and rows: each row is a document.  Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from devdelta.llm.common import row_id, staged

BUCKETS = 1024


def shared_leaves(leaves: DataFrame, fraction: float, weights: dict[tuple[str, ...], float] | None, epochs: int) -> DataFrame:
    """LEAF, budget, held: the budgets of ``leaves`` (LEAF, tokens) out of ``fraction`` of all tokens, by grouped aggregations."""
    spark = leaves.sparkSession
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    top = F.lit(0).alias("top")  # names the root
    above = leaves.select(top).limit(1).withColumn("offered", F.lit(min(fraction * total, float(total * epochs))))
    for depth in range(1, len(LEAF) + 1):
        parent, path = ["top", *LEAF[: depth - 1]], ["top", *LEAF[:depth]]
        nodes = leaves.groupBy(top, *LEAF[:depth]).agg(F.sum("tokens").alias("tokens"))
        given = [(0, *p, float(w)) for p, w in (weights or {}).items() if len(p) == depth]
        if given:
            ddl = ", ".join(["top int", *(f"{c} string" for c in LEAF[:depth]), "weight double"])
            nodes = nodes.join(spark.createDataFrame(given, ddl), path, "left")
        else:
            nodes = nodes.withColumn("weight", F.lit(None).cast("double"))
        nodes = nodes.withColumn("weight", F.coalesce("weight", F.lit(1.0))).where("weight > 0 and tokens > 0")
        nodes = nodes.withColumn("capacity", F.col("tokens") * F.lit(float(epochs)))
        nodes = staged(nodes.withColumn("ratio", F.expr("capacity / weight")), "mix-nodes")
        # One row for each ratio: with equal weights at most the root of twice the tokens.
        steps = nodes.groupBy(*parent, "ratio").agg(F.sum("capacity").alias("c"), F.sum("weight").alias("w"))
        rising = Window.partitionBy(*parent).orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
        falling = Window.partitionBy(*parent).orderBy(F.desc("ratio")).rowsBetween(Window.unboundedPreceding, 0)
        steps = steps.select(*parent, "ratio", F.coalesce(F.sum("c").over(rising), F.lit(0.0)).alias("before"), F.sum("w").over(falling).alias("rest"))
        steps = steps.join(above.select(*parent, "offered"), parent).withColumn("unit", F.expr("(offered - before) / rest"))
        # Siblings that are not full share by weight; null if all are full.
        units = steps.groupBy(*parent).agg(F.max(F.expr("CASE WHEN unit < ratio THEN unit END")).alias("unit"))
        shared = nodes.join(F.broadcast(units) if depth == 1 else units, parent)  # one row for the root
        above = staged(shared.select(*path, "tokens", F.expr("least(capacity, unit * weight)").alias("offered")), "mix-offers")
    return above.select(*LEAF, F.expr("cast(floor(offered + 1e-6) as long)").alias("budget"), F.col("tokens").alias("held"))


def token_count(text: Column) -> Column:
    """Words between white space, one at least."""
    return F.greatest(F.size(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+")), F.lit(1)).cast("long")


def default_domain() -> Column:
    """A source's domain: its name without the digits at its end."""
    return F.regexp_replace(F.coalesce(F.col("source").cast("string"), F.lit("")), r"\d+$", "")


LEAF = ["domain", "language", "source_name"]


def mix(
    docs: DataFrame,
    fraction: float = 0.5,
    weights: dict[tuple[str, ...], float] | None = None,
    epochs: int = 1,
    seed: int = 17,
    domain: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """row_id, doc_id, domain, language, source_name, epoch, tokens of each document taken in each epoch.

    The budget is ``fraction`` of all tokens.  ``row_id`` numbers the rows of ``docs``.
    """
    named = docs.select(
        row_id(docs).alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (default_domain() if domain is None else domain).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_name"),
        token_count(F.col("text").cast("string")).alias("tokens"),
        F.xxhash64(F.col("text").cast("string")).alias("content"),  # tells rows with one id apart
    )
    rows = staged(named, "mix-tokens")
    leaves = staged(rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    shares = shared_leaves(leaves, fraction, weights, epochs)
    # An epoch's budget: what is left of the leaf's after the whole epochs before it.
    per_epoch = shares.select(*LEAF, "held", "budget", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    per_epoch = per_epoch.withColumn("allowed", F.least("held", F.col("budget") - F.col("epoch") * F.col("held")))
    per_epoch = per_epoch.where("allowed > 0").select(*LEAF, "epoch", "allowed")

    order = F.xxhash64(F.lit(seed), F.col("epoch"), F.col("doc_id"), F.col("content"))
    taken = rows.join(per_epoch, LEAF).withColumn("order", order)
    taken = taken.withColumn("bucket", F.expr(f"shiftright(`order`, {64 - (buckets - 1).bit_length()})"))
    sums = taken.groupBy(*LEAF, "epoch", "bucket").agg(F.sum("tokens").alias("t"))
    upto = Window.partitionBy(*LEAF, "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*LEAF, "epoch", "bucket", "t", F.coalesce(F.sum("t").over(upto), F.lit(0)).alias("before"))
    joined = taken.join(sums, [*LEAF, "epoch", "bucket"]).where("before < allowed")
    columns = ["row_id", "doc_id", *LEAF, "epoch", "tokens"]
    whole = joined.where("before + t <= allowed").select(*columns)
    inside = Window.partitionBy(*LEAF, "epoch", "bucket").orderBy("order", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    last = joined.where("before + t > allowed").withColumn("sofar", F.col("before") + F.sum("tokens").over(inside))
    return whole.unionByName(last.where("sofar <= allowed").select(*columns))
