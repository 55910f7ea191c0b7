"""Whitening against dense linear algebra, the solver on hard matrices, and awkward rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from convoy.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def exact(vectors):
    """Deviations, the falling variances, and the directions, by the covariance and a library's solver."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = (x * n - sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return deviations, e[::-1], v[:, ::-1], centred


def whitened(spark, rows, components=32, parts=3):
    points = whitening.grid(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    model = whitening.fit(points, components)
    return model, whitening.whiten(points, model).collect(), whitening.identity_error(points, model)


def compare(rows, kept, components, model, error):
    deviations, e, v, centred = exact([v for _, v in kept])
    found = {(r.id, r.component): r for r in rows}
    k = len(model.variances)
    assert len(found) == len(rows) == k * len(kept) and error < 1e-9
    assert np.allclose(model.variances, e[:k], rtol=1e-9) and k == min(components, len(e))
    for j in range(k):
        want = centred @ v[:, j] / math.sqrt(e[j])
        values = np.array([found[i, j + 1].whitened for i, _ in kept])
        assert np.allclose(values * np.sign(values @ want), want, atol=1e-7)
        assert math.isclose(found[kept[0][0], j + 1].explained, e[j] / e.sum(), rel_tol=1e-9)
    assert [found[i, 1].deviation for i, _ in kept] == deviations


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_against_dense_algebra(spark, parts):
    draw = np.random.default_rng(parts)
    rows = [(i, (draw.standard_normal(6) * [9, 3, 1, 0.5, 0.2, 0.1]).tolist()) for i in range(150)]
    model, got, error = whitened(spark, rows, 4, parts)
    compare(got, rows, 4, model, error)


def test_the_query_on_the_sample(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    kept = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    rows = queries.op13_whitening(spark, SF).collect()
    assert {r.n for r in rows} == {len(kept)} and len({r.identity_error for r in rows}) == 1
    model = whitening.fit(whitening.grid(table))
    compare([r for r in whitening.whiten(whitening.grid(table), model).collect()], kept, 32, model, rows[0].identity_error)


def test_unusable_rows_take_no_part(spark):
    good = [(i, [math.sin(i * j + 1) for j in range(1, 5)]) for i in range(20)]
    bad = [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [1.0, math.nan, 0.0, 0.0]), (53, [math.inf, 0.0, 0.0, 0.0]), (54, [1.0]), (55, [])]
    model, rows, error = whitened(spark, good + bad, 3)
    compare(rows, good, 3, model, error)


def test_repeated_rows_null_ids_and_clashing_names(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.5, 0.25]), (3, [-2.0, 7.0])]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("id", "x", "v", "n", "part", "component")})
    points = whitening.grid(table)
    model = whitening.fit(points)
    got = whitening.whiten(points, model).collect()
    assert model.n == 5 and len(got) == 10
    ones = [r for r in got if r.id == 1 and r.component == 1]
    assert len(ones) == 2 and ones[0] == ones[1] and sum(r.id is None for r in got) == 2


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [0.5, 0.5]) for i in range(9)], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    model, got, error = whitened(spark, rows)
    assert got == [] and error == 0.0 and len(model.variances) == 0


def test_directions_without_variance_are_left_out(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(a), float(b), float(a), 3.0, float(a + b)]) for i, (a, b) in enumerate(draw.integers(-9, 9, (60, 2)))]
    model, got, error = whitened(spark, rows)
    assert len(model.variances) == 2 and len(got) == 120 and error < 1e-9


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [float(i) * 1e7, 1.0]) for i in range(1000)]
    _, got, _ = whitened(spark, rows, 1)
    deviations, *_ = exact([v for _, v in rows])
    assert {r.id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for (i, _), d in zip(rows, deviations)}
    assert None in {r.deviation for r in got}


@pytest.mark.parametrize("seed", range(6))
def test_values_keep_their_relative_accuracy(seed):
    """Of a bidiagonal matrix with entries over thirty orders of magnitude."""
    draw = np.random.default_rng(seed)
    n = 12
    q, e = 10.0 ** draw.uniform(-15, 15, n), 10.0 ** draw.uniform(-15, 15, n - 1)
    got = whitening.dqds(q, e)
    assert (np.diff(got) <= 0).all()
    # the product of all squared singular values is that of the squared diagonal, whatever the rest
    assert math.isclose(np.log(got).sum(), np.log(q).sum(), abs_tol=1e-10)
    b = np.diag(np.sqrt(q)) + np.diag(np.sqrt(e), 1)
    assert np.allclose(got[:3], np.linalg.svd(b, compute_uv=False)[:3] ** 2, rtol=1e-10)


@pytest.mark.parametrize("kind", ["random", "graded", "equal", "pairs", "glued", "rank", "identity", "one"])
def test_directions_of_hard_matrices(kind):
    draw = np.random.default_rng(7)
    n = 40
    turn, _ = np.linalg.qr(draw.standard_normal((n, n)))
    values = {
        "random": draw.uniform(1, 2, n), "graded": 10.0 ** -np.linspace(0, 10, n), "equal": np.ones(n),
        "pairs": np.repeat(np.arange(1.0, n / 2 + 1), 2), "glued": 1 + 1e-12 * np.arange(n), "rank": np.arange(n) // 20 * 1.0,
        "identity": np.ones(n), "one": np.eye(n)[0],
    }[kind]
    matrix = np.eye(n) if kind == "identity" else np.linalg.qr(np.sqrt(values)[:, None] * turn.T, mode="r")
    found, axes = whitening.principal(matrix, n)
    want = np.sort(values)[::-1]
    rank = int((want > 0).sum())
    assert len(found) == rank and np.allclose(found, want[:rank], rtol=1e-7 if kind == "graded" else 1e-12)
    assert np.abs(axes.T @ axes - np.eye(rank)).max() < 1e-10
    product = axes.T @ (matrix.T @ matrix) @ axes
    assert np.abs(product - np.diag(found)).max() < 1e-11 * found[0]
