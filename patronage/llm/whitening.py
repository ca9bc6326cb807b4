"""Whitening of vectors on their first principal components.

The covariance is taken from the centred scatter, gathered over all rows. A Cholesky
factorisation with pivoting turns it into a triangular factor of full column rank, and one-sided
Jacobi rotates the columns of that factor until they are orthogonal: their norms give the
eigenvalues, the normalised columns (rows put back in order) the components.

Entries are whole numbers, so the sums are exact: rows are shifted by the rounded mean before
they are multiplied, and what the rounding leaves is taken off in whole numbers. The model does
not depend on how rows lie in partitions, and reruns agree to the last bit.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .staging import staged

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0 ** 53 - 2.0 ** 12  # of entries beyond, the whole number is no long; they count as not finite
DIGIT_BITS = 125       # of a sum of products, to stay within 38 digits
BLOCK = 4096           # rows of one matrix product
EXACT = 2 ** 53        # whole numbers that a double holds
SWEEPS = 60


@dataclass
class Model:
    """n vectors of dimension len(sums); eigenvalues fall, components are columns."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def whole_vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of whole numbers) for each length of vector in a column; vectors that
    are null, or hold a null or an entry that is not finite, are left out."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    bad = np.concatenate([[0], np.cumsum(~(np.abs(values) <= LARGEST))])
    size = np.diff(offsets)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    out = []
    for length in np.unique(size[good]).tolist():
        rows = np.flatnonzero(good & (size == length))
        entries = values[offsets[rows][:, None] + np.arange(length)]
        out.append((rows, np.floor(SCALE * entries).astype(np.int64) + SHIFT))
    return out


def _sums(batches):
    for b in batches:
        for rows, x in whole_vectors(b.column(0)):
            d, most = x.shape[1], int(np.abs(x).max(initial=0))
            total = (x if most * len(x) < 2 ** 63 else x.astype(object)).sum(0).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()),
                                              pa.array([str(v) for v in [len(rows), *total]], pa.string()), pa.array([most] * (d + 1), pa.int64())], names=["length", "j", "v", "most"])


def _products(d: int, middle: np.ndarray, drop: int):
    """Sums of products of shifted rows without their last `drop` bits, the upper triangle for each task."""
    def run(batches):
        total = np.zeros((d, d), object)
        for b in batches:
            for _, x in whole_vectors(b.column(0)):
                if x.shape[1] != d:
                    continue
                for i in range(0, len(x), BLOCK):
                    y = x[i:i + BLOCK] - middle
                    y = y if not drop else (y + (1 << drop - 1)) >> drop
                    if int(np.abs(y).max()) ** 2 * len(y) < EXACT:
                        f = y.astype(np.float64)
                        total += (f.T @ f).astype(np.int64).astype(object)
                    else:
                        total += y.astype(object).T @ y.astype(object)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]], pa.string())], names=["i", "j", "v"])
    return run


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L of full column rank with L L' = a, the rows in the order of a. Pivots are the largest
    that are left; it ends when they are no larger than rounding."""
    left = np.array(np.diag(a), np.float64)
    least = len(a) * np.finfo(float).eps * left.max(initial=0)
    out, order = np.zeros(a.shape), np.arange(len(a))
    for k in range(len(a)):
        p = k + int(np.argmax(left[order[k:]]))
        if not left[order[p]] > least:
            return out[:, :k]
        order[[k, p]] = order[[p, k]]
        pivot, rest = order[k], order[k + 1:]
        out[pivot, k] = np.sqrt(left[pivot])
        out[rest, k] = (a[rest, pivot] - out[rest, :k] @ out[pivot, :k]) / out[pivot, k]
        left[rest] -= out[rest, k] ** 2
    return out


def rotated(factor: np.ndarray) -> np.ndarray:
    """The factor times a rotation that makes its columns orthogonal. Each step of a sweep takes
    disjoint pairs of columns, as in a round of a tournament, all at once."""
    out, r = factor.copy(), factor.shape[1]
    seats = np.arange(r + r % 2)
    enough = np.finfo(float).eps * np.sqrt(len(out))
    for _ in range(SWEEPS if r > 1 else 0):
        worst = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[:len(seats) // 2], seats[::-1][:len(seats) // 2]
            met = (p < r) & (q < r)
            p, q = p[met], q[met]
            x, y = out[:, p], out[:, q]
            a, b, g = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(g) / np.sqrt(a * b)
            worst = max(worst, off.max())
            turn = off > enough
            z = (b - a) / (2 * np.where(turn, g, 1))
            t = np.where(z >= 0, 1, -1) / (np.abs(z) + np.hypot(1, z))
            t = np.where(turn, t, 0)
            c = 1 / np.hypot(1, t)
            s = c * t
            out[:, p], out[:, q] = c * x - s * y, s * x + c * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= enough:
            break
    return out


def decomposed(scatter: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of scatter / n and their components as columns; the largest entry of
    each component is positive. There are as many as the rank."""
    turned = rotated(pivoted_cholesky(scatter))
    norms = np.sqrt((turned * turned).sum(0))
    order = np.argsort(-norms, kind="stable")
    parts = turned[:, order] / norms[order]
    sign = np.sign(parts[np.abs(parts).argmax(0), np.arange(parts.shape[1])]) if parts.size else 1.0
    return norms[order] ** 2 / n, parts * sign


def fit(vectors: DataFrame, col: str = "embedding") -> Model | None:
    """The model of all usable vectors of the most frequent length (the longer one in a tie), or
    None without any. The driver gets one number for each pair of dimensions.

    Sums are exact while products of all rows stay within 38 digits; of larger entries, as many
    last bits as needed are rounded away, far behind a double's.
    """
    only = vectors.select(F.col(col).cast("array<double>").alias("v"))
    sums = staged(only.mapInArrow(_sums, "length int, j int, v string, most long").groupBy("length", "j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.max("most").alias("most")), "sums")
    best = sums.filter("j = -1 and length > 0").orderBy(F.desc("v"), F.desc("length")).first()
    if best is None:
        return None
    d, n = best.length, int(best.v)
    total = {r.j: int(r.v) for r in sums.filter((F.col("length") == d) & (F.col("j") >= 0)).collect()}
    s = [total[j] for j in range(d)]
    middle = [(2 * v + n) // (2 * n) for v in s]
    rest = [v - n * m for v, m in zip(s, middle)]
    drop = max(0, (2 * int(best.most)).bit_length() - (DIGIT_BITS - n.bit_length()) // 2)
    made = only.mapInArrow(_products(d, np.array(middle, np.int64), drop), "i int, j int, v string")
    scatter = np.zeros((d, d))
    for r in made.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).toLocalIterator():
        scatter[r.i, r.j] = scatter[r.j, r.i] = ((n * int(r.v) << 2 * drop) - rest[r.i] * rest[r.j]) / n
    values, parts = decomposed(scatter, n)
    return Model(n, s, values, parts, float(np.trace(scatter)) / n)


def _whiten(model: Model, k: int):
    n, d = model.n, len(model.sums)
    middle = np.array([v // n for v in model.sums], np.int64)
    rest = np.array([v % n for v in model.sums], np.int64)
    turn = model.components[:, :k] / np.sqrt(model.eigenvalues[:k])

    def run(batches):
        for b in batches:
            for rows, x in whole_vectors(b.column(1)):
                if x.shape[1] != d:
                    continue
                y = x - middle
                top = int(np.abs(y).max()) + 1
                if (top * n) ** 2 * d < 2 ** 63:
                    z = y * n - rest
                    spread, exact = z / n, (z * z).sum(1).tolist()
                else:
                    z = y.astype(object) * n - rest
                    spread, exact = (z / n).astype(np.float64), (z * z).sum(1)
                white = spread @ turn
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array([str(v) for v in exact], pa.string()),
                                                  pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), k).cast(pa.list_(pa.float64()))], names=["vec_id", "deviation", "white"])
    return run


def whitened(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding", count: int = 8) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): for each usable
    vector a row for each of the first `count` components, or as many as the covariance has rank.

    A vector that is null, or holds a null, an infinite entry or one beyond LARGEST, has no rows,
    nor has one of another length than most. Null and repeated ids stay. Equal vectors only, one
    vector or an empty table leave nothing to whiten: no rows. `deviation` is an exact
    decimal, null beyond 38 digits. Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).cast("array<double>").alias("v"))
    model = fit(vectors, col)
    k = min(count, len(model.eigenvalues)) if model else 0
    out = "vec_id long, deviation string, white array<double>"
    white = staged(rows.mapInArrow(_whiten(model, k), out), "white") if k else rows.sparkSession.createDataFrame([], out)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    error = F.greatest(F.lit(0.0), *[F.abs(F.covar_pop(F.col("white")[i], F.col("white")[j]) - float(i == j)) for i, j in pairs], F.lit(0.0))
    parts = [F.struct(F.lit(i + 1).alias("component"), F.col("white")[i].alias("whitened"), F.lit(float(model.eigenvalues[i] / model.trace)).alias("explained")) for i in range(k)]
    each = F.explode(F.array(*parts) if parts else F.lit(None).cast("array<struct<component: int, whitened: double, explained: double>>"))
    return (white.select("vec_id", "deviation", each.alias("c")).crossJoin(F.broadcast(white.agg(error.alias("identity_error"))))  # one row
            .select("vec_id", "c.component", F.lit(model.n if model else 0).cast("long").alias("n"),
                    F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"), "c.whitened", "c.explained", "identity_error"))
