"""Whitening of embeddings by spectral divide-and-conquer.

Every entry c of a vector becomes the integer ``floor(64 * c) + 1000000``; the
covariance V of these vectors (divisor n) is the only thing that reaches the
driver: d sums, then d x d doubles, d being the vectors' length.  Tasks add up
centred outer products of their rows; the matrix is summed row by row, each
row's partial sums in one task, so that no task holds more than some rows of it.

V is taken apart by polar decompositions.  With a shift s between its
eigenvalues, the polar factor U of V - s*I has eigenvalues +1 and -1, and
(U + I) / 2 projects on the eigenvectors above s.  Orthonormal bases of that
space and of its complement split V into two smaller matrices, which are split
again until single components are left.  U comes from the dynamically weighted
Halley iteration (QDWH), whose steps need a QR or a Cholesky factorisation and
products of matrices only.

The components (d x 32 doubles at most) and the means are broadcast, and every
row is projected where it lies; nothing is joined or shuffled.

Rows that are null, hold null or non-finite entries, or entries that no long can
hold (64 * c beyond 2^62), are dropped.  Vectors shorter than the longest lack
entries and count as holding nulls.  A component without variance (numerically:
below d * 2^-52 of the largest) has null ``whitened``.  A ``deviation`` that no long can hold
is null.  Null and repeated ids: every row is returned.  Empty table, or none
left: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
EPS = float(np.finfo(np.float64).eps)
LONG_MAX = 2**63 - 1


def polar(a: np.ndarray, steps: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by the QDWH iteration.

    An eigenvalue of 0 keeps no sign: the factor isn't orthogonal then.
    """
    n = len(a)
    size = np.linalg.norm(a)  # above the largest singular value
    if size == 0:
        return np.zeros_like(a)
    x, eye = a / size, np.eye(n)
    low = EPS  # a lower bound of the singular values; smaller ones come out unconverged
    for _ in range(steps):
        if abs(1 - low) < 4 * EPS:
            break
        d = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.concatenate((np.sqrt(wc) * x, eye)))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            z = np.linalg.cholesky(eye + wc * x.T @ x)
            half = np.linalg.solve(z, x.T)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z.T, half).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
    return x


def _split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the spaces of a's eigenvalues above and below some shift; None if a is a multiple of I."""
    n = len(a)
    mean = np.trace(a) / n
    off = a - mean * np.eye(n)
    scale = np.linalg.norm(off)
    if scale <= 4 * EPS * np.linalg.norm(a):
        return None
    # The mean lies between the outer eigenvalues; the median splits more evenly, where it splits.
    shifts = [float(np.median(np.diag(a))), mean]
    shifts += [mean + scale / n * float(x) for x in rng.uniform(-0.5, 0.5, 30)]
    for s in shifts:
        u = polar(a - s * np.eye(n))
        k = int(round((np.trace(u) + n) / 2))
        if not 0 < k < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-12 * n:
            continue
        p = (u + np.eye(n)) / 2
        q, _ = np.linalg.qr(np.concatenate((p @ rng.normal(size=(n, k)), rng.normal(size=(n, n - k))), 1))
        # one more step of subspace iteration: the projector on the first, its complement on the rest
        first, _ = np.linalg.qr(p @ q[:, :k])
        rest, _ = np.linalg.qr(q[:, k:] - first @ (first.T @ q[:, k:]))
        if np.linalg.norm(first.T @ a @ rest) <= 64 * EPS * n * np.linalg.norm(a):
            return first, rest
    return None


def spectrum(v: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns."""
    rng = np.random.default_rng(seed)
    values, vectors = [], []
    todo = [np.eye(len(v))]
    while todo:
        basis = todo.pop()
        inside = basis.T @ v @ basis
        inside = (inside + inside.T) / 2
        parts = _split(inside, rng) if len(inside) > 1 else None
        if parts is None:
            values += np.diag(inside).tolist()
            vectors += list(basis.T)
        else:
            todo += [basis @ part for part in parts]
    order = np.argsort(-np.array(values), kind="stable")
    q = np.array(vectors)[order].T
    # Rounding in the splits adds up: one first-order step makes q's columns orthonormal and V diagonal again.
    q = q @ (1.5 * np.eye(len(v)) - 0.5 * q.T @ q)
    b = q.T @ v @ q
    e = np.diag(b).copy()
    gap = e[None, :] - e[:, None]
    apart = np.abs(gap) > 1e-8 * np.abs(e).max()  # equal eigenvalues have no directions of their own
    q = q @ (np.eye(len(v)) + np.where(apart, b / np.where(apart, gap, 1), 0.0))
    q = q @ (1.5 * np.eye(len(v)) - 0.5 * q.T @ q)
    e = np.einsum("ij,ij->j", q, v @ q)
    if np.abs(v @ q - q * e).max() > 1e-10 * np.linalg.norm(v):
        raise ArithmeticError("the covariance did not split into components")
    order = np.argsort(-e, kind="stable")
    return e[order], q[:, order]


def integers(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors stay, and those as integers, a row each."""
    full = pc.fill_null(pc.equal(pc.list_value_length(column), d), False)
    flat = column.filter(full).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    c = flat.reshape(-1, d) * SCALE
    fit = (np.abs(c) <= 2.0**62).all(1)  # false for NaN, too
    ok = full.to_numpy(zero_copy_only=False).astype(bool)
    ok[ok] = fit
    return ok, np.floor(c[fit]).astype(np.int64) + OFFSET


def _column_sums(x: np.ndarray) -> list[int]:
    if len(x) and float(np.abs(x).max()) * len(x) >= 2.0**62:
        return [int(s) for s in x.astype(object).sum(0)]
    return x.sum(0).tolist()


@dataclass
class Centre:
    """n vectors with sums S: S = n * whole + rest, 0 <= rest < n."""

    n: int
    whole: np.ndarray  # of longs
    rest: np.ndarray  # of longs

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles; the difference of the integers is exact."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n*x - S)^2, exact; None beyond a long."""
        y = x - self.whole
        largest = float(np.abs(y).max()) if y.size else 0.0
        if (self.n * (largest + 1)) ** 2 * x.shape[1] < 2.0**62:
            return ((self.n * y - self.rest) ** 2).sum(1).tolist()
        exact = ((self.n * y.astype(object) - self.rest) ** 2).sum(1)
        return [int(s) if s <= LONG_MAX else None for s in exact]


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            _, x = integers(b["embedding"], d)
            n += len(x)
            total = [s + t for s, t in zip(total, _column_sums(x))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d + 1), pa.int32()), pa.array([Decimal(t) for t in [*total, n]], pa.decimal128(38, 0))], ["i", "s"]
            )

    return run


def _outer(d: int, centre: Centre, project: np.ndarray | None):
    """Rows of the sum of outer products of the centred (and projected) vectors; row -1: their plain sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            _, x = integers(b["embedding"], d)
            y = centre.centred(x)
            if project is not None:
                y = y @ project
            part = np.concatenate((y.sum(0)[None], y.T @ y))
            total = part if total is None else total + part
        if total is not None:
            yield _matrix_rows({i - 1: r for i, r in enumerate(total)})

    return run


def _matrix_rows(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
    values = pa.array([r.tolist() for r in rows.values()], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), values], ["i", "v"])


def _row_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, v in zip(b["i"].to_pylist(), b["v"]):
            v = v.values.to_numpy()
            total[i] = total[i] + v if i in total else v
    if total:
        yield _matrix_rows(total)


def _moments(rows: DataFrame, d: int, centre: Centre, project: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (divisor n, centred at that mean) of the centred, projected vectors."""
    ddl = "i int, v array<double>"
    parts = rows.select("embedding").mapInArrow(_outer(d, centre, project), ddl)
    got = parts.repartition("i").mapInArrow(_row_sums, ddl).orderBy("i").collect()  # d + 1 rows of d doubles
    mean = np.array(got[0]["v"]) / centre.n
    return mean, np.array([r["v"] for r in got[1:]]) / centre.n - np.outer(mean, mean)


@dataclass
class Whitening:
    """What is broadcast: the centre, the components and their figures."""

    d: int
    centre: Centre
    project: np.ndarray  # component columns over sqrt(e)
    explained: list[float | None]
    identity_error: float | None


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all vectors in ``rows`` (embedding array<double>); None if there are none."""
    d = rows.agg(F.max(F.size("embedding"))).first()[0]
    if d is None or d <= 0:
        return None
    sums = rows.select("embedding").mapInArrow(_sums(d), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    total = [int(r["s"]) for r in sums.orderBy("i").collect()]  # d + 1 rows
    if not total:
        return None
    n = total.pop()
    centre = Centre(n, np.array([s // n for s in total]), np.array([s % n for s in total]))
    _, v = _moments(rows, d, centre)
    e, q = spectrum((v + v.T) / 2)
    live = e > d * EPS * max(e[0], 0.0)
    k = min(components, d)
    scale = np.where(live, 1 / np.sqrt(np.where(live, e, 1)), np.nan)[:k]
    project, trace = q[:, :k] * scale, float(np.trace(v))
    used = int(live[:k].sum())  # the eigenvalues fall
    error = None
    if used:
        _, white = _moments(rows, d, centre, project[:, :used])
        error = float(np.abs(white - np.eye(used)).max())
    return Whitening(d, centre, project, [float(x) / trace if trace > 0 else None for x in e[:k]], error)


def _whitened(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Whitening = shared.value
        k = w.project.shape[1]
        for big in batches:
            for start in range(0, big.num_rows, 4096):
                b = big.slice(start, 4096)
                ok, x = integers(b["embedding"], w.d)
                m = len(x)
                white = (w.centre.centred(x) @ w.project).ravel()
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        b["vec_id"].filter(pa.array(ok)).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, w.centre.n, np.int64)),
                        pa.array(w.centre.deviations(x), pa.int64()).take(pa.array(each)),
                        pa.array(white, mask=np.isnan(white)),
                        pa.array(w.explained * m, pa.float64()),
                        pa.array([w.identity_error] * (m * k), pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_vectors(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector of ``vectors`` (vec_id, embedding) that stays and each component, strongest first."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whitening = fitted(rows, components)
    if whitening is None:
        return spark.createDataFrame([], OUTPUT)
    # d x 32 doubles and a few more: bounded by the vectors' length
    return rows.mapInArrow(_whitened(spark.sparkContext.broadcast(whitening)), OUTPUT)
