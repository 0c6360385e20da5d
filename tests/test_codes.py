"""code_of / change predicate: SQL expressions equal their per-row twins."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from devdelta.functions.codes import changed_against, code_of, py_changed_against, py_code_of

alphabet = st.sampled_from(list("ab:,"))
texts = st.text(alphabet, max_size=8)
names = st.sampled_from(["a", "b", "", "a:b", "ab"])


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(texts, texts, names), min_size=200, max_size=200))
def test_sql_matches_python(spark, cases):
    df = spark.createDataFrame(cases, "prev string, cur string, name string")
    out = df.select(
        "prev", "cur", "name",
        code_of(F.col("cur"), F.col("name")).alias("code"),
        changed_against(F.col("prev"), F.col("cur"), F.col("name")).alias("changed"),
    ).collect()
    for r in out:
        assert r.code == py_code_of(r.cur, r.name), r
        assert r.changed == py_changed_against(r.prev, r.cur, r.name), r


def test_known_cases(spark):
    assert py_code_of("A:1,B:2", "B") == "2"
    assert py_code_of("T:a:b", "T") == "a"
    assert py_code_of("T:", "T") == ""
    assert py_code_of("X:1", "T") is None
    assert py_changed_against("T:x", "T:x", "T") is False
    assert py_changed_against("T:x,T:y", "T:x", "T") is True
