"""Neighbours against a full search."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from convoy.llm import ann

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, asked, k):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[(i, tuple(v))] = np.array(v, np.float32).astype(float)
    common = max({len(v) for v in usable.values()}, key=lambda d: sum(len(v) == d for v in usable.values()))
    usable = {key: v for key, v in usable.items() if len(v) == common}
    out = []
    for (q, _), vector in usable.items():
        if q in asked:
            scored = sorted((-float((v * vector).sum()), i) for (i, _), v in usable.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, k=20, **options):
    table = spark.createDataFrame(rows, VECTORS).withColumns({"id": F.lit(1), "block": F.lit(2), "v": F.lit(3)})
    result = ann.search(table, table.where("vec_id % 20 = 0"), k=k, **options)
    return sorted(tuple(r) for r in result.collect())


def test_small_tables_are_searched_whole(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.standard_normal(8) * (1 + i % 5)]) for i in range(120)]
    same = [1.0, 2.0, 0.5, 0.0, -1.0, 3.0, 1.0, 1.0]
    rows += [(i, same) for i in range(200, 260)]
    rows += [(300, None), (301, [0.0] * 8), (302, [None] + same[1:]), (303, [float("nan")] + same[1:]),
             (304, [float("inf")] + same[1:]), (305, [1.0, 2.0]), (None, same), (200, same), (320, []), (340, None)]
    want = brute(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 20)
    got = found(spark, rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-12)


def test_every_query_gets_as_many_as_asked_for(spark):
    """Also where windows miss many neighbours, whose places the sample's best then fill, once each."""
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.standard_normal(32)]) for i in range(400)]
    got = found(spark, rows, settings=ann.Settings(miss=0.5))
    assert [g[:2] for g in got] == [(q, n) for q in range(0, 400, 20) for n in range(1, 21)]
    assert len({(g[0], g[2]) for g in got}) == len(got)


def test_fewer_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    assert [g[:3] for g in found(spark, rows)] == [(0, 1, 1), (0, 2, 2)]
    assert found(spark, [(0, [1.0, 0.0])]) == []
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0])]) == []


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = table.toPandas().sort_values("vec_id")
    ids, v = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    got = {}
    for r in ann.search(table, table.where("vec_id % 50 = 0"), k=20).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    shares = []
    for q, near in got.items():
        scores = v @ v[np.flatnonzero(ids == q)[0]]
        scores[ids == q] = -np.inf
        shares.append(len(near & set(ids[np.lexsort((ids, -scores))[:20]].tolist())) / 20)
    assert len(shares) == int((ids % 50 == 0).sum())
    assert np.mean(shares) >= 0.9


@pytest.mark.parametrize("components, lengths", [(64, "log-normal"), (64, "one long"), (256, "equal")])
def test_recall_whatever_the_lengths(spark, components, lengths):
    """Neighbours are found where lengths differ, and where hashing tells vectors of many components apart badly."""
    draw = np.random.default_rng(3)
    v = draw.standard_normal((8000, components))
    v /= np.linalg.norm(v, axis=1)[:, None]
    if lengths == "log-normal":
        v *= np.exp(0.6 * draw.standard_normal(len(v)))[:, None]
    elif lengths == "one long":
        v[4001] *= 3
    v = v.astype(np.float32)
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], VECTORS)
    got = {}
    for r in ann.search(table, table.where("vec_id % 80 = 0"), k=20).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    shares, v = [], v.astype(float)
    for q in range(0, len(v), 80):
        scores = v @ v[q]
        scores[q] = -np.inf
        shares.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(shares) >= 0.97
