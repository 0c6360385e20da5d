"""Quality rules whose thresholds adapt to each language and source.

One pass computes a document's counts.  For every (lang, source) a mergeable
quantile sketch (KLL) of each derived measure is built with map-side partial
aggregation, so a source that holds a third of all rows is summarised by many
tasks and only sketches of bounded size are merged.  A measure's threshold is a
quartile plus a multiple of the quartile range (in the direction that marks a
bad document); the thresholds are joined to the documents by language and
source, and a document beyond any of them is not kept.

A group's quartiles are drawn toward those of its language's merged sketch, the
more the fewer documents it has: n of n + ``SHRINK`` parts are its own.  There
is no size at which its limits change by a jump.

The measures are shares, so a long document isn't flagged for its length:
repeated words in windows of three, symbols per word, duplicate lines per line,
and characters per word (both ends).  The first three are 0 for most documents,
and a quartile range of zeros tells nothing.  They are taken to the angle whose
sine squared is the share (its variance hardly depends on the share), with 3/8
of a case added: the angle of no case in n words depends on n, so a group's
quartiles have a range, the one its lengths give, and its limit is the share by
which a document departs from the angles of its group.  Repeats have a long
tail among good documents, hence the larger multiple.  The multiples were
chosen on labelled rows outside the held-out part.  A range counts as a small
width at least, for groups whose documents are all alike.

Null text: no words.  Null language or source: a group of its own.  Empty table:
no rows.  Repeated ids: every row is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdelta.llm.common import staged, utf8

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
KLL_K = 400  # rank error of about 0.4 %
SHRINK = 100  # documents at which a group's own quartiles count as much as its language's


def _angle(cases: str, of: str) -> str:
    return f"asin(sqrt(least(({cases} + 0.375D) / ({of} + 0.75D), 1D)))"


# measure -> (SQL text, +1: large is bad or -1: small is bad, ranges beyond the quartile, the least range)
MEASURES = {
    "repeat_share": (_angle("n_repeat_words", "n_words"), 1, 12.0, 0.02),
    "symbol_share": (_angle("n_symbols", "n_words"), 1, 6.0, 0.01),
    "dup_line_share": (_angle("n_dup_lines", "n_lines"), 1, 4.0, 0.02),
    "long_words": ("coalesce(word_chars / nullif(n_words, 0), 0D)", 1, 6.0, 0.1),
    "short_words": ("coalesce(word_chars / nullif(n_words, 0), 0D)", -1, 4.0, 0.1),
}


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of one text."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = utf8(text).split()  # bytes.split takes the words between [\x20\x09-\x0D]
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    n = len(words)
    repeated = 0
    if n > 3:
        number: dict[bytes, int] = {}
        ids = [number.setdefault(w, len(number)) for w in words]
        v = len(number)
        grams = [(a * v + b) * v + c for a, b, c in zip(ids, ids[1:], ids[2:])]
        if len(set(grams)) < len(grams):
            seen: set[int] = set()
            twice: set[int] = set()
            for g in grams:
                (twice if g in seen else seen).add(g)
            upto = 0  # words before it are counted
            for i, g in enumerate(grams):
                if g in twice:
                    repeated += i + 3 - max(upto, i)
                    upto = i + 3
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [text_counts(t) for t in b["text"].to_pylist()]
        cols = list(zip(*rows)) if rows else [[]] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], b["lang"], b["source"], *(pa.array(c, pa.int64()) for c in cols)],
            ["doc_id", "lang", "source", *COUNTS],
        )


def document_counts(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    ddl = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_counted, ddl)


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def _quartiles() -> list[Column]:
    return [F.kll_sketch_get_quantile_double(m, F.lit(p)).alias(f"{m}_{q}") for m in MEASURES for q, p in (("q1", 0.25), ("q3", 0.75))]


def thresholds(measured: DataFrame, fence: float | None = None, k: int = KLL_K, shrink: float = SHRINK) -> DataFrame:
    """lang, source and a threshold for each measure, from sketches of the rows that pass the base rules.

    ``fence`` replaces every measure's multiple of the quartile range.
    """
    aggs = [F.kll_sketch_agg_double(F.col(m), F.lit(k)).alias(m) for m in MEASURES]
    sketches = measured.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n"), *aggs)
    merged = sketches.groupBy("lang").agg(*[F.kll_merge_agg_double(F.col(m), F.lit(k)).alias(m) for m in MEASURES])
    own = sketches.select("lang", "source", "n", *_quartiles()).alias("own")
    language = merged.select("lang", *_quartiles()).alias("language")
    limits = []
    for m, (_, sign, times, width) in MEASURES.items():
        q1, q3 = (F.expr(f"(n * own.{m}_{q} + {float(shrink)}D * language.{m}_{q}) / (n + {float(shrink)}D)") for q in ("q1", "q3"))
        far = F.lit(times if fence is None else fence) * F.greatest(q3 - q1, F.lit(width))
        limits.append((q3 + far if sign > 0 else q1 - far).alias(f"{m}_limit"))
    return own.join(language, F.col("own.lang").eqNullSafe(F.col("language.lang"))).select("own.lang", "source", *limits)


def quality_rules(docs: DataFrame, fence: float | None = None) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of ``docs`` (doc_id, text, lang, source)."""
    measured = document_counts(docs).withColumn("base_failed", base_failed())
    measured = staged(measured.withColumns({m: F.expr(e) for m, (e, *_) in MEASURES.items()}), "rule-counts")
    limits = thresholds(measured, fence)
    on = measured["lang"].eqNullSafe(limits["lang"]) & measured["source"].eqNullSafe(limits["source"])
    beyond = F.lit(False)
    for m, (_, sign, *_) in MEASURES.items():
        limit = F.col(f"{m}_limit")
        beyond = beyond | F.coalesce(F.col(m) > limit if sign > 0 else F.col(m) < limit, F.lit(False))
    joined = measured.join(limits, on, "left")
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~(F.col("base_failed") | beyond)).alias("kept"),
    )
