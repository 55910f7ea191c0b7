"""Whitening of embeddings through a bidiagonal qd solver.

Vectors are put on a grid of integers, so that sums are exact. Every task centres its rows and keeps the triangle of their QR
factorisation; triangles are stacked and factorised again, some at a time, until one is left, whose size depends on the number
of components only. Householder reflections make it bidiagonal, dqds finds its singular values to high relative accuracy, and
twisted factorisations give the direction of each. The covariance itself is never formed, so that small variances survive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that are factorised at once, and triangles that are.
ROWS, FAN = 4096, 16
EPS = np.finfo(float).eps
LONG = 1 << 63


@dataclass(frozen=True)
class Model:
    """A fitted whitening: rows, sums, unit directions as columns, their variances, and the variance of all directions."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    total: float


def grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shift: int = 1_000_000):
    """Vectors as whole numbers floor(scale * c) + shift, as (id, x array<long>).

    Rows are left out whose vector is null or holds null or non-finite entries, and those of another length than most.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("v IS NOT NULL")
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    common = max(lengths, key=lambda r: (r["n"], -r["d"]))["d"] if lengths else 0
    whole = F.transform("v", lambda c: F.floor(c * scale).cast("long") + shift)
    return rows.where(F.size("v") == common).select("id", whole.alias("x"))


def fit(points: DataFrame, components: int = 32) -> Model:
    """Fit a whitening to all rows of a grid.

    Directions are numbered by falling variance, at most ``components`` of them. Those without variance, as all are if there
    are no rows or only equal ones, can't be whitened and are left out. Each direction's largest entry is positive.
    """
    parts = points.mapInArrow(_sums, "pos int, s long").groupBy("pos").agg(F.sum("s").alias("s")).collect()
    sums = {r["pos"]: r["s"] for r in parts}
    n, d = sums.pop(-1, 0), len(sums)
    ordered = tuple(sums[i] for i in range(d))
    if not n or not d:
        return Model(n, ordered, np.zeros((d, 0)), np.zeros(0), 0.0)
    triangles = points.mapInArrow(partial(_factor, n, ordered), "part int, r array<double>")
    left = points.rdd.getNumPartitions()
    while left > 1:
        merged = triangles.select((F.col("part") / FAN).cast("int").alias("part"), "r")
        triangles = merged.groupBy("part").applyInArrow(_again, "part int, r array<double>")
        left = -(-left // FAN)
    triangle = np.linalg.qr(np.array([r["r"] for r in triangles.collect()]), mode="r")
    variances, axes = principal(triangle, components)
    total = float((triangle * triangle).sum()) / n
    return Model(n, ordered, axes, variances / n, total)


def _blocks(batches, n: int, sums: tuple[int, ...]):
    """Ids, whole numbers near zero and centred rows, some thousand at a time.

    With b the nearest whole number to a mean, x - b is small and exact, and what remains of the mean is below one half.
    """
    near = [(2 * s + n) // (2 * n) for s in sums]
    rest = np.array([s - n * b for s, b in zip(sums, near)], np.int64)
    near = np.array(near, np.int64)
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            part = batch.slice(start, ROWS)
            small = part.column("x").flatten().to_numpy().reshape(len(part), len(sums)) - near
            yield part.column("id"), small, small - rest / n, rest


def _sums(batches):
    """A task's rows (-1) and sums by dimension."""
    n, sums = 0, None
    for batch in batches:
        if len(batch):
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
            if x.size and float(np.abs(x.astype(float)).max()) * len(x) > LONG / 4:
                raise OverflowError("entries too large for exact sums")
            own = x.sum(axis=0).tolist()
            n, sums = n + len(x), own if sums is None else [a + b for a, b in zip(sums, own)]
    if n:
        arrays = [pa.array([-1, *range(len(sums))], pa.int32()), pa.array([n, *sums], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["pos", "s"])


def _factor(n, sums, batches):
    """The triangle of a task's centred rows."""
    from pyspark import TaskContext

    triangle = np.zeros((0, len(sums)))
    for _, _, centred, _ in _blocks(batches, n, sums):
        triangle = np.linalg.qr(np.vstack([triangle, centred]), mode="r")
    yield _rows(TaskContext.get().partitionId(), triangle)


def _again(triangles: pa.Table) -> pa.Table:
    """One triangle of several. Which comes first is of no account but for rounding, so they are sorted."""
    rows = np.array(sorted(triangles.column("r").to_pylist()))
    part = triangles.column("part")[0].as_py()
    return pa.Table.from_batches([_rows(part, np.linalg.qr(rows, mode="r"))])


def _rows(part: int, triangle: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([part] * len(triangle), pa.int32()), pa.array(triangle.tolist(), pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(arrays, ["part", "r"])


# ---------------------------------------------------------------- the small matrix


def principal(triangle: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a matrix, falling, and its right singular vectors as columns; none for values of zero."""
    d = triangle.shape[1]
    square = np.zeros((max(d, len(triangle)), d))
    square[: len(triangle)] = triangle
    size = np.abs(square).max()
    if not size:
        return np.zeros(0), np.zeros((d, 0))
    a, b, right = bidiagonal(square / size)
    values = dqds(a * a, b * b)[:components]
    values = values[values > values[0] * (EPS * d) ** 2 * 16]
    axes = right @ twisted_vectors(a, b, values)
    axes /= np.linalg.norm(axes, axis=0)
    signs = np.sign(axes[np.argmax(np.abs(axes), axis=0), np.arange(axes.shape[1])])
    return values * size * size, axes * signs


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A vector h of unit length whose reflection x - 2 h (h x) keeps the first entry only, and that entry."""
    length = np.linalg.norm(x)
    if not length:
        return np.zeros_like(x), 0.0
    kept = -math.copysign(length, x[0])
    h = x.copy()
    h[0] -= kept
    return h / np.linalg.norm(h), kept


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, the entries above it, and V, with matrix = U B V^T for orthogonal U and V."""
    m, d = matrix.copy(), matrix.shape[1]
    a, b, reflections = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for i in range(d):
        h, a[i] = _reflector(m[i:, i])
        m[i:, i + 1 :] -= 2 * np.outer(h, h @ m[i:, i + 1 :])
        if i + 1 < d:
            h, b[i] = _reflector(m[i, i + 1 :])
            m[i + 1 :, i + 1 :] -= 2 * np.outer(m[i + 1 :, i + 1 :] @ h, h)
            reflections.append((i + 1, h))
    right = np.eye(d)
    for start, h in reversed(reflections):
        right[start:, start:] -= 2 * np.outer(h, h @ right[start:, start:])
    return a, b, right


def _dqd(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step, and its d: the diagonal before e is added. Works without subtraction if shift is 0."""
    d, new_q, new_e, ds = q[0] - shift, [], [], []
    for i in range(len(e)):
        ds.append(d)
        both = d + e[i]
        ratio = q[i + 1] / both if both else 0.0
        new_q.append(both)
        new_e.append(e[i] * ratio)
        d = (d * ratio if both else q[i + 1]) - shift
    ds.append(d)
    return [*new_q, d], new_e, ds


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the bidiagonal matrix whose squared entries are ``q`` and, above them, ``e``.

    A step without a shift gives the diagonal of the inverse, whose sum bounds the smallest value from below. The next step
    shifts by that bound, so that every value keeps its relative accuracy. A part ends where an entry of e is negligible.
    """
    found: list[float] = []
    parts = [(q.tolist(), e.tolist(), 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        while True:
            cuts = [i for i, x in enumerate(e) if x <= EPS * EPS * (shifted + min(q[i], q[i + 1])) or not x]
            if cuts:
                ends = [0, *(i + 1 for i in cuts), len(q)]
                parts += [(q[s:t], e[s : t - 1], shifted) for s, t in zip(ends, ends[1:])]
                break
            if len(q) == 1:
                found.append(shifted + q[0])
                break
            if q[0] < q[-1]:  # the smallest value leaves at the end
                q, e = _turned(q, e)
            q, e, ds = _dqd(q, e, 0.0)
            if min(ds) <= 0:
                continue
            shift = (1 - 16 * len(q) * EPS) / sum(1 / d for d in ds)
            if shift > EPS * shifted:
                new_q, new_e, ds = _dqd(q, e, shift)
                if min(ds) >= 0 and all(x >= 0 for x in new_e):
                    q, e, shifted = new_q, new_e, shifted + shift
    return np.array(sorted(found, reverse=True))


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same matrix from the other end: a qd array of the reversed order with the same singular values."""
    return q[::-1], e[::-1]


def twisted_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors z with B^T B z = value z, as columns. Those of values close together are kept orthogonal."""
    a = np.where(np.abs(a) > EPS * np.abs(a).max() * 1e-3, a, EPS * np.abs(a).max() * 1e-3)
    diagonal, lower = (a * a).tolist(), (b / a[:-1]).tolist()
    draw, made = np.random.default_rng(42), np.zeros((len(a), len(values)))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * values[j - 1]:
            first = j  # far enough from the one before
        close = made[:, first:j]
        alone = j == first and (j + 1 == len(values) or value - values[j + 1] > 1e-3 * value)
        # among close values a pivot counts as zero early, so that no direction of theirs is preferred
        twist = _Twisted(diagonal, lower, float(value), EPS * EPS * max(diagonal) if alone else 4 * EPS * float(value))
        z = twist.vector() if alone else draw.standard_normal(len(a))
        for _ in range(1 if alone else 4):
            z = z / np.linalg.norm(z) if alone else twist.solve(z / np.linalg.norm(z))
            for _ in range(2):
                z = z / np.linalg.norm(z)
                z = z - close @ (close.T @ z)
        made[:, j] = z / np.linalg.norm(z)
    return made


class _Twisted:
    """L D L^T - value, factorised from both ends towards the row where the pivot is smallest."""

    def __init__(self, diagonal: list[float], lower: list[float], value: float, tiny: float):
        n = len(diagonal)
        self.down, self.up = [0.0] * n, [0.0] * n  # pivots from the top, and from the bottom
        self.left, self.right = [0.0] * (n - 1), [0.0] * (n - 1)
        s, stationary = -value, [-value]
        for i in range(n - 1):
            self.down[i] = self._pivot(diagonal[i] + s, tiny)
            self.left[i] = diagonal[i] * lower[i] / self.down[i]
            s = self.left[i] * lower[i] * s - value
            stationary.append(s)
        self.down[n - 1] = self._pivot(diagonal[n - 1] + s, tiny)
        p, progressive = diagonal[n - 1] - value, [0.0] * n
        progressive[n - 1] = p
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = self._pivot(diagonal[i] * lower[i] * lower[i] + p, tiny)
            ratio = diagonal[i] / self.up[i + 1]
            self.right[i] = lower[i] * ratio
            p = p * ratio - value
            progressive[i] = p
        self.up[0] = self._pivot(p, tiny)
        middle = [s + p + value for s, p in zip(stationary, progressive)]
        self.row = min(range(n), key=lambda i: abs(middle[i]))
        self.middle = self._pivot(middle[self.row], tiny)

    @staticmethod
    def _pivot(x: float, tiny: float) -> float:
        return x if abs(x) > tiny else tiny

    def _spread(self, z: list[float]) -> np.ndarray:
        for i in range(self.row - 1, -1, -1):
            z[i] -= self.left[i] * z[i + 1]
        for i in range(self.row, len(z) - 1):
            z[i + 1] -= self.right[i] * z[i]
        return np.array(z)

    def vector(self) -> np.ndarray:
        z = [0.0] * len(self.down)
        z[self.row] = 1.0
        return self._spread(z)

    def solve(self, right: np.ndarray) -> np.ndarray:
        z, k = right.tolist(), self.row
        for i in range(k):
            z[i + 1] -= self.left[i] * z[i]
        for i in range(len(z) - 2, k - 1, -1):
            z[i] -= self.right[i] * z[i + 1]
        pivots = [*self.down[:k], self.middle, *self.up[k + 1 :]]
        return self._spread([x / p for x, p in zip(z, pivots)])


# ---------------------------------------------------------------- whitened rows


def _project(model: Model, centred: np.ndarray) -> np.ndarray:
    return centred @ (model.axes / np.sqrt(model.variances))


def identity_error(points: DataFrame, model: Model) -> float:
    """The largest entry, by size, of the whitened rows' covariance minus the identity; 0 without components."""
    k = len(model.variances)
    if not k:
        return 0.0
    parts = points.mapInArrow(partial(_products, model), "pos int, s double").groupBy("pos").agg(F.sum("s").alias("s"))
    sums = np.zeros(k * (k + 1))
    for r in parts.collect():
        sums[r["pos"]] = r["s"]
    means, second = sums[:k] / model.n, sums[k:].reshape(k, k) / model.n
    return float(np.abs(second - np.outer(means, means) - np.eye(k)).max())


def _products(model, batches):
    k = len(model.variances)
    sums = np.zeros(k * (k + 1))
    for _, _, centred, _ in _blocks(batches, model.n, model.sums):
        w = _project(model, centred)
        sums[:k] += w.sum(axis=0)
        sums[k:] += (w.T @ w).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], ["pos", "s"])


def whiten(points: DataFrame, model: Model) -> DataFrame:
    """A row for every row of the grid and every component, as (id, component, deviation long, whitened, explained).

    ``deviation`` is the exact sum over dimensions of (n x - S)^2, null if it has no place in 64 bits. Repeated rows and null
    ids stay.
    """
    return points.mapInArrow(
        partial(_whitened, model), "id long, component int, deviation long, whitened double, explained double"
    )


def _whitened(model, batches):
    k, n = len(model.variances), model.n
    explained = model.variances / model.total if k else np.zeros(0)
    for ids, small, centred, rest in _blocks(batches, n, model.sums):
        rows = len(small)
        # (n a - r)^2 summed is n^2 sum a^2 - 2 n sum a r + sum r^2, each sum being small
        squares, mixed = _exact(small, small), _exact(small, np.broadcast_to(rest, small.shape))
        last = sum(r * r for r in rest.tolist())
        deviations = [n * n * p - 2 * n * q + last for p, q in zip(squares, mixed)]
        deviations = pa.array([x if x < LONG else None for x in deviations], pa.int64())
        index = pa.array(np.repeat(np.arange(rows), k))
        arrays = [
            ids.take(index), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), deviations.take(index),
            pa.array(_project(model, centred).ravel()), pa.array(np.tile(explained, rows)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "component", "deviation", "whitened", "explained"])


def _exact(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Row sums of products of integers."""
    if np.abs(a.astype(float)).max(initial=0) * np.abs(b.astype(float)).max(initial=0) * max(a.shape[1], 1) < LONG / 2:
        return (a * b).sum(axis=1).tolist()
    return (a.astype(object) * b.astype(object)).sum(axis=1).tolist()
