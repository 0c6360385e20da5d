import math
import random

import numpy as np
import pytest

from devdelta.llm import whitening as W

DDL = "vec_id long, embedding array<float>, label int, n long, i int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, 7) for i, v in rows], DDL)


def some(n, d, seed=1):
    rng = np.random.default_rng(seed)
    turn = rng.normal(size=(d, d))
    return [np.float32(v).tolist() for v in rng.normal(size=(n, d)) * np.linspace(1, 3, d) @ turn]


@pytest.mark.parametrize("kind", ["random", "diagonal", "equal", "zero", "two values", "low rank"])
@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_spectrum_equals_the_eigenvalues(kind, n):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = {
        "random": rng.uniform(0, 9, n),
        "diagonal": np.arange(n) + 1.0,
        "equal": np.full(n, 3.0),
        "zero": np.zeros(n),
        "two values": np.array([2.0] * (n // 2) + [1.0] * (n - n // 2)),
        "low rank": np.where(np.arange(n) < 2, 5.0, 0.0),
    }[kind]
    v = np.diag(values) if kind == "diagonal" else q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, c = W.spectrum(v)
    assert np.allclose(e, np.sort(values)[::-1], atol=1e-12)
    assert np.allclose(v @ c, c * e, atol=1e-12) and np.allclose(c.T @ c, np.eye(n), atol=1e-12)


def test_polar_factor():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    e, q = np.linalg.eigh(a)
    assert np.allclose(W.polar(a), q @ np.diag(np.sign(e)) @ q.T, atol=1e-12)


def brute(rows, components=32):
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v in rows], object)
    n, total = len(x), x.sum(0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(r, total))) for r in x]
    y = np.array([[float(a) for a in r] for r in (n * x - total)]) / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return n, deviation, y @ q / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("n,d", [(300, 40), (50, 3)])
def test_rows_equal_brute_force_up_to_sign(spark, n, d):
    rows = [(i, v) for i, v in enumerate(some(n, d))]
    m, deviation, white, explained = brute(rows)
    got = {(r["vec_id"], r["component"]): r for r in W.whitened_vectors(vectors(spark, rows).repartition(5)).collect()}
    k = min(32, d)
    assert len(got) == n * k and {r["n"] for r in got.values()} == {m}
    assert [got[i, 1]["deviation"] for i in range(n)] == deviation
    ours = np.array([[got[i, c + 1]["whitened"] for c in range(k)] for i in range(n)])
    sign = np.sign((ours * white).sum(0))
    assert np.allclose(ours * sign, white, atol=1e-8)
    assert np.allclose([got[0, c + 1]["explained"] for c in range(k)], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in got.values()}) == 1 and got[0, 1]["identity_error"] < 1e-9


def test_awkward_vectors(spark):
    good = some(20, 4)
    rows = [(i, v) for i, v in enumerate(good)] + [
        (100, None),
        (101, [1.0, None, 2.0, 3.0]),
        (102, [1.0, float("nan"), 2.0, 3.0]),
        (103, [float("inf"), 0.0, 0.0, 0.0]),
        (104, [1.0, 2.0]),
        (105, []),
        (106, [1e30, 0.0, 0.0, 0.0]),
        (None, good[0]),
        (0, good[0]),
    ]
    got = W.whitened_vectors(vectors(spark, rows)).collect()
    assert sorted({r["vec_id"] for r in got if r["vec_id"] is not None}) == list(range(20))
    assert len(got) == 22 * 4 and {r["n"] for r in got} == {22}
    assert W.whitened_vectors(vectors(spark, rows[20:27][:2])).collect() == []
    assert W.whitened_vectors(vectors(spark, [])).collect() == []
    one = W.whitened_vectors(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None), (2, 0, None, None, None)]


def test_large_entries_keep_exact_deviations(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-(2**30), 2**30)) for _ in range(3)]) for i in range(8)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    _, deviation, _, _ = brute(rows)
    got = {r["vec_id"]: r["deviation"] for r in W.whitened_vectors(vectors(spark, rows)).where("component = 1").collect()}
    assert [got[i] for i in range(8)] == [d if d < 2**63 else None for d in deviation]


def test_hot_vector(spark):
    rows = [(i, v) for i, v in enumerate(some(60, 5))] + [(1000 + i, some(1, 5, 9)[0]) for i in range(40)]
    _, deviation, white, _ = brute(rows)
    got = W.whitened_vectors(vectors(spark, rows).repartition(7)).orderBy("vec_id", "component").collect()
    ours = np.array([r["whitened"] for r in got]).reshape(100, 5)
    assert np.allclose(np.abs(ours), np.abs(white), atol=1e-8)
