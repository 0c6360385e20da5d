import corpus_pipeline as C
from devdelta.llm import queries
from tests.llm.helpers import awkward, none

SF = "/root/testdata/sf0.001"


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "near_duplicates", "mixing", "packing"]


def test_stages_on_awkward_rows(spark):
    docs = awkward(spark).coalesce(1)
    labels = [(i, t) for i, t in ((d["doc_id"], d["text"]) for d in docs.collect())]
    out = C.exact_dedup(spark, docs, SF)
    kept = out.collect()
    assert out.columns == C.COLUMNS
    assert len(kept) == len({(t or "").lower() if (t or "").isascii() else t for _, t in labels})
    near = C.near_duplicates(spark, C.staged(out, "t"), SF).collect()
    assert 5 < len(near) < len(kept)
    assert all(stage(spark, none(spark), SF).collect() == [] for _, stage in C.STAGES[1:])


def test_run_packs_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = C.run(spark, SF).collect()
    ids = {r["doc_id"] for r in rows}
    assert 0.5 * docs.count() < len(ids) < docs.count()
    assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_filters_and_packing_on_awkward_rows(spark):
    docs = C.staged(awkward(spark), "t")
    rows = sorted(map(tuple, docs.select(*C.COLUMNS).collect()), key=str)
    for stage in (C.toxicity, C.mixing):
        out = stage(spark, docs, SF)
        assert out.columns == C.COLUMNS
        left = list(rows)
        for r in out.collect():
            left.remove(tuple(r))  # only rows of docs, each as often as it stands there at most
    packed = C.packing(spark, docs, SF).collect()
    ends = [r for r in packed if r["start"] + r["length"] == r["doc_tokens"]]
    assert len(ends) == len(rows) and sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in ends)
    assert C.toxicity(spark, none(spark), SF).collect() == []
