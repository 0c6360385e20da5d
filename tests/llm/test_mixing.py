import random
from collections import Counter, defaultdict

from devdelta.llm import mixing as M
from tests.llm import budget_tree as T
from tests.llm.helpers import awkward, documents, none, words


def budgets(spark, leaves, total, epochs=1, weights=None):
    rows = spark.createDataFrame([(*p, t) for p, t in leaves], "domain string, language string, source_name string, tokens long")
    shares = M.shared_leaves(rows, total / sum(t for _, t in leaves), weights, epochs)
    return {tuple(r)[:3]: r["budget"] for r in shares.collect()}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = [(("a", "en", "s1"), 10), (("a", "en", "s2"), 1000), (("a", "de", "s3"), 1000), (("b", "en", "s4"), 1000)]
    root = T.tree(leaves)
    T.share_out(root, 400, 1)
    got = dict(T.leaf_budgets(root))
    # a and b get 200 each, a's languages 100 each; s1 holds 10, so s2 takes 90, not s3
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 90, ("a", "de", "s3"): 100, ("b", "en", "s4"): 200}
    assert budgets(spark, leaves, 400) == got


def test_what_siblings_cannot_take_goes_up(spark):
    leaves = [(("a", "en", "s1"), 10), (("a", "en", "s2"), 20), (("a", "de", "s3"), 1000), (("b", "en", "s4"), 1000)]
    root = T.tree(leaves, {("b",): 3.0})
    T.share_out(root, 400, 1)
    got = dict(T.leaf_budgets(root))
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 20, ("a", "de", "s3"): 70, ("b", "en", "s4"): 300}
    assert budgets(spark, leaves, 400, weights={("b",): 3.0}) == got
    root = T.tree(leaves)
    assert T.share_out(root, 5000, 2) == 5000 - 2 * 2030 and root.budget == 2 * 2030
    assert budgets(spark, leaves, 5000, 2) == {p: 2 * t for p, t in leaves}


def sizes(texts):
    return [max(1, len((t or "").split())) for t in texts]


def test_leaves_take_a_prefix_of_seeded_epochs(spark):
    rng = random.Random(1)
    texts = [words(rng, rng.randrange(1, 30)) for _ in range(400)]
    df = documents(spark, texts)
    tokens = sizes(texts)
    for buckets in (1, 4, 1024):
        got = M.mix(df, 0.9, {("src", "en"): 4.0}, epochs=2, buckets=buckets).collect()
        held, taken = Counter(), Counter()
        by_epoch = defaultdict(Counter)
        for i, t in enumerate(tokens):
            held[(["en", "de", ""][i % 3], f"src{i % 5}")] += t
        for r in got:
            leaf = (r["language"], r["source_name"])
            assert r["tokens"] == tokens[r["doc_id"]]
            taken[leaf] += r["tokens"]
            by_epoch[leaf, r["epoch"]][r["doc_id"]] += 1
        root = T.tree([(("src", *leaf), t) for leaf, t in held.items()], {("src", "en"): 4.0})
        T.share_out(root, 0.9 * sum(tokens), 2)
        for (_, *leaf), budget in T.leaf_budgets(root):
            assert budget - 60 < taken[tuple(leaf)] <= budget
            for e in (0, 1):
                assert set(by_epoch[tuple(leaf), e].values()) <= {1}
            if by_epoch[tuple(leaf), 1]:  # the first epoch is whole
                assert sum(tokens[d] for d in by_epoch[tuple(leaf), 0]) == held[tuple(leaf)]
    again = M.mix(df, 0.3, seed=1).collect(), M.mix(df, 0.3, seed=1).collect(), M.mix(df, 0.3, seed=2).collect()
    ids = [sorted(r["doc_id"] for r in x) for x in again]
    assert ids[0] == ids[1] != ids[2]


def test_a_leaf_leaves_less_unspent_than_a_document_left_out(spark):
    rng = random.Random(5)
    texts = [words(rng, rng.choice([1, 10, 500])) for _ in range(150)]
    tokens, leaf = sizes(texts), lambda i: ("src", ["en", "de", ""][i % 3], f"src{i % 5}")
    held, taken, left_out = Counter(), Counter(), Counter()
    got = {r["doc_id"] for r in M.mix(documents(spark, texts), 0.5).collect()}
    for i, t in enumerate(tokens):
        held[leaf(i)] += t
        if i in got:
            taken[leaf(i)] += t
        else:
            left_out[leaf(i)] = max(left_out[leaf(i)], t)
    root = T.tree(list(held.items()))
    T.share_out(root, 0.5 * sum(tokens), 1)
    assert all(0 <= b - taken[p] < max(left_out[p], 1) for p, b in T.leaf_budgets(root))


def test_budgets_equal_those_of_a_plain_tree(spark):
    rng = random.Random(2)
    held = {(f"d{rng.randrange(4)}", f"l{rng.randrange(3)}", f"s{i}"): rng.choice([1, 5, 5, 40, 300]) for i in range(60)}
    weights = {("d1",): 3.0, ("d2", "l0"): 0.25, **{p: rng.choice([0.0, 0.5, 2.0]) for p in list(held)[::4]}}
    leaves = spark.createDataFrame([(*p, t) for p, t in held.items()], "domain string, language string, source_name string, tokens long")
    for fraction, given, epochs in ((0.3, weights, 1), (0.9, weights, 2), (2.0, None, 1)):
        root = T.tree(list(held.items()), given)
        T.share_out(root, fraction * root.tokens, epochs)
        got = {tuple(r)[:3]: (r["budget"], r["held"]) for r in M.shared_leaves(leaves, fraction, given, epochs).collect()}
        assert got == {p: (b, held[p]) for p, b in T.leaf_budgets(root) if p in got}
        assert all(b == 0 for p, b in T.leaf_budgets(root) if p not in got)


def test_awkward_and_empty(spark):
    df = awkward(spark)
    got = M.mix(df, 1.0).collect()
    assert len(got) == df.count() and len({r["row_id"] for r in got}) == len(got)
    assert M.mix(none(spark)).collect() == []
