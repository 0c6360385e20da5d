"""Small tables for the tests of the subpackage llm."""

import random

DOCS_DDL = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, ids=None, ddl=DOCS_DDL):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ["en", "de", None][k % 3], f"src{k % 5}", len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, ddl)


def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows and an extra column with a name the operators use."""
    rng = random.Random(3)
    long = words(rng, 30_000, 5000)
    texts = [None, "", "  \n", "A", "a", long, long.upper(), long[:-5], words(rng, 60), words(rng, 60), "é ß 日本 \U0001f600 x"]
    rows = [(i, t, None if i == 2 else "en", None if i == 3 else "src0", 0, i, "x") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, "A", "en", "src0", 1, 1, "y"), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS_DDL + ", uid long, node string")


def none(spark):
    return spark.createDataFrame([], DOCS_DDL)
