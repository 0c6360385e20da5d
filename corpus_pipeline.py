"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage takes all that its predecessor kept, calls one operator of
``devdelta.llm`` and lets its decisions take effect.  All but the last return
the columns of ``documents``; the last returns a row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdelta.llm.common import row_id, staged, table
from devdelta.llm.exact_dedup import exact_groups
from devdelta.llm.jaccard_join import similar_components
from devdelta.llm.mixing import mix
from devdelta.llm.packing import pack
from devdelta.llm.toxicity import fitted, without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share of the tokens that the mixture takes.
FRACTION = 0.8


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose numbers are in ``kept`` (uid)."""
    numbered = docs.select(*COLUMNS, row_id(docs).alias("uid"))
    return numbered.join(kept, "uid", "left_semi").select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    docs = docs.select(*COLUMNS)
    return without_toxic(docs, fitted(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts stays, the one with the largest doc_id."""
    return _only(docs, exact_groups(docs).where("kept").select("uid"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that links of similar shingle sets connect stays: five words, 0.8 or more."""
    return _only(docs, similar_components(docs, percent=80, size=5).where("kept").select("uid"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Equal budgets for the sources of each language, out of FRACTION of all tokens."""
    return _only(docs, mix(docs, fraction=FRACTION).select(F.col("row_id").alias("uid")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Learnt scores, components of links and tokenizers are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
