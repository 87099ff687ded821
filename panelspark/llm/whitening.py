"""Whitening of vectors by spectral divide and conquer.

The covariance of the distinct vectors is added up over the tasks, centred at the
exact mean.  Its eigenvectors come from polar decompositions: the polar factor of a
symmetric matrix less a shift is its sign, with eigenvalue 1 above the shift and -1
below, so (factor + identity) / 2 projects on the invariant subspace above it.  An
orthonormal basis of that subspace and one of its complement make the matrix block
diagonal, and both blocks are divided in the same way until they hold one component
each.  The polar factor is found by Halley's iteration with dynamical weights, each
step a QR decomposition, which needs about six steps whatever the spectrum.

The matrix has the vectors' dimension squared as its size, whatever the number of
rows; it and the components are all that reaches the driver or is broadcast.

Defined results: vectors that are null, or hold null or non-finite entries, are
dropped, and so are empty ones and, where lengths differ, those that do not have the
commonest length (of equally common ones the greatest); repeated rows are rows of the
result, but count once in the fit; components without variance are left out, so a
table of equal vectors, and an empty one, gives an empty result; further columns are
not read.  Entries or deviations beyond 64 bits raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ready, stored

#: x = floor(SCALE * entry) + OFFSET; components returned; variances below this share of
#: the largest count as none.
SCALE, OFFSET, COMPONENTS, NO_VARIANCE = 64, 1_000_000, 16, 1e-13
#: Steps of the polar iteration at most, and values that a task packs at once.
STEPS, VALUES = 60, 2_000_000


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QR-based Halley steps
    with dynamical weights."""
    n = len(a)
    scale = np.linalg.norm(a, 2)
    x, low = a / scale, 1e-16
    for _ in range(STEPS):
        d = np.cbrt(4 * (1 - low ** 2) / low ** 4) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        moved = np.linalg.norm(new - x)
        x, low = (new + new.T) / 2, min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
        if moved < 1e-15 * np.sqrt(n) or moved < 1e-5 and 1 - low < 1e-15:  # cubic: the next step is exact
            break
    return x


def divided(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of ``a`` above and below a shift;
    None if it has but one eigenvalue."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= 4e-16 * n * max(abs(mean), np.linalg.norm(a)):
        return None
    for shift in (np.median(np.diag(a)), mean, *(mean + f * spread / n for f in (0.01, -0.01, 0.03, -0.03, 0.1, -0.1))):
        above = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        size = int(round(np.trace(above)))
        if 0 < size < n and np.linalg.norm(above @ above - above) < 1e-10 * n:
            order = np.argsort(-np.diag(above), kind="stable")  # its longest columns span the subspace best
            q, _ = np.linalg.qr(above[:, order[:size]], mode="complete")
            q, _ = np.linalg.qr(np.hstack([above @ q[:, :size], (np.eye(n) - above) @ q[:, size:]]))
            return q[:, :size], q[:, size:]
    return None


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix."""
    n = len(a)
    parts = divided(a) if n > 1 else None
    if parts is None:
        return np.diag(a).copy(), np.eye(n)
    values, vectors = [], []
    for basis in parts:
        block = basis.T @ a @ basis
        e, v = spectrum((block + block.T) / 2)
        values.append(e)
        vectors.append(basis @ v)
    e, v = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def refined(a: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs after a step of first-order correction, which takes out what rounding
    has left between components whose eigenvalues lie close together."""
    v, _ = np.linalg.qr(v)
    b = v.T @ a @ v
    e = np.diag(b)
    gap = e[None, :] - e[:, None]
    size = np.abs(e).max(initial=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        turn = np.where(np.abs(gap) > 1e-10 * size, b / gap, 0.0)
    np.fill_diagonal(turn, 0.0)
    if np.abs(turn).max(initial=0) < 1e-6:
        v, _ = np.linalg.qr(v + v @ turn)
    e = np.einsum("ij,ik,kj->j", v, a, v)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def integers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows without null or non-finite entries."""
    c = F.col(vector_col).cast("array<double>")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    x = F.transform(c, lambda v: F.floor(v * F.lit(float(SCALE))).cast("long") + F.lit(OFFSET))
    return df.where(F.col(vector_col).isNotNull() & finite & (F.size(vector_col) > 0)).select(
        F.col(id_col).alias("vec_id"), x.alias("x"))


def sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """(rows, exact sum of each dimension) of ``x``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0), dims)
                n += len(x)
                if int(np.abs(x).max()) * len(x) >= 2 ** 63:
                    raise OverflowError("sums do not fit into 64 bits")
                total = [a + int(b) for a, b in zip(total, x.sum(0))]
        yield pa.record_batch([pa.array(range(dims + 1), pa.int32()), pa.array([*map(str, total), str(n)])], names=["k", "v"])

    got = {r["k"]: int(r["v"]) for r in fit.select("x").mapInArrow(add, "k int, v string").groupBy("k").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    return got[dims], [got[k] for k in range(dims)]


def second_moments(fit: DataFrame, dims: int, mean: np.ndarray, onto: np.ndarray) -> np.ndarray:
    """Sums over the rows of products of each two columns, and of each column, of
    (x - mean) projected by ``onto``: (columns + 1) squared."""
    shipped = fit.sparkSession.sparkContext.broadcast((mean, onto))
    wide = onto.shape[1] + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, onto = shipped.value
        total = np.zeros((wide, wide))
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, VALUES // dims)):
                x = matrix(batch.column(0).slice(at, max(1, VALUES // dims)), dims)
                z = np.hstack([(x - mean) @ onto, np.ones((len(x), 1))])
                total += z.T @ z
        up = np.triu_indices(wide)
        yield pa.record_batch([pa.array(up[0] * wide + up[1], pa.int32()), pa.array(total[up])], names=["cell", "v"])

    out = np.zeros((wide, wide))
    for r in fit.select("x").mapInArrow(add, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        out[divmod(r["cell"], wide)] = out[divmod(r["cell"], wide)[::-1]] = r["v"]
    return out


def covariance(moments: np.ndarray, n: int) -> np.ndarray:
    """Of the columns of second_moments(), which are centred but for rounding."""
    off = moments[:-1, -1] / n
    return moments[:-1, :-1] / n - np.outer(off, off)


def whitened_rows(rows: DataFrame, n: int, total: list[int], e: np.ndarray, onto: np.ndarray, trace: float,
                  error: float) -> DataFrame:
    dims, parts = len(total), onto.shape[1]
    shipped = rows.sparkSession.sparkContext.broadcast((np.array(total, dtype=object), onto))
    kind = rows.schema["vec_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, onto = shipped.value
        fits = max(abs(int(s)) for s in total) < 2 ** 62
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, VALUES // max(dims, parts))):
                part = batch.slice(at, max(1, VALUES // max(dims, parts)))
                x = matrix(part.column(1), dims)
                most = max(abs(int(x.max())), abs(int(x.min())))
                off = (n * x - total.astype(np.int64)) if fits and n * most < 2 ** 62 else n * x.astype(object) - total
                far = int(np.abs(off).max())
                if far * far * dims < 2 ** 63:
                    deviation = (off.astype(np.int64) ** 2).sum(1)
                else:
                    deviation = [sum(int(v) ** 2 for v in row) for row in off]
                    if max(deviation) >= 2 ** 63:
                        raise OverflowError("deviations do not fit into 64 bits")
                w = (off.astype(np.float64) / n) @ onto
                m = len(x)
                again = pa.array(np.repeat(np.arange(m), parts))
                yield pa.record_batch([
                    part.column(0).take(again), pa.array(np.tile(np.arange(1, parts + 1), m), pa.int32()),
                    pa.array(np.full(m * parts, n), pa.int64()), pa.array(list(np.repeat(deviation, parts)), pa.int64()),
                    pa.array(w.ravel()), pa.array(np.tile(e / trace, m)), pa.array(np.full(m * parts, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(each, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                 "explained double, identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row
    that is kept and each of the first ``components`` components."""
    ready(df)
    rows = stored(integers(df, id_col, vector_col), "integers")
    length = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    dims = length["d"] if length else 1
    rows = rows.where(F.size("x") == dims)
    fit = stored(rows.select("x").distinct(), "fit")
    n, total = sums(fit, dims)
    mean = np.array([s // n + (s % n) / n for s in total]) if n else np.zeros(dims)
    v = covariance(second_moments(fit, dims, mean, np.eye(dims)), max(n, 1))
    e, vectors = refined(v, spectrum(v)[1])
    good = int((e[:components] > NO_VARIANCE * max(e[0], 0.0)).sum()) if e[0] > 0 else 0
    onto = vectors[:, :good] / np.sqrt(e[:good])
    if not good:
        return whitened_rows(rows.where("false"), 1, [0] * dims, np.ones(1), np.zeros((dims, 1)), 1.0, 0.0)
    white = covariance(second_moments(fit, dims, mean, onto), n)
    error = float(np.abs(white - np.eye(good)).max())
    return whitened_rows(rows, n, total, e[:good], onto, float(np.trace(v)), error)
