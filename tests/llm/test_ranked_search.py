"""Ranked search against brute force, on awkward rows, ties and tiles of every size."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from convoy.llm import ranked_search
from tests.llm.data import awkward, docs, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, k=10):
    held = [(i, Counter(words(t))) for i, t in texts]
    n_docs, length = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    found = []
    for item, own in asked.items():
        scored = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in own & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (100 - 90 + 90 * n * n_docs // length)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        found += [(item, r, None if m else i, -s) for r, (s, m, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def got(spark, texts, items, **options):
    table = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked_search.search(docs(spark, texts), table, **options).collect()), key=repr)


ITEMS = [(1, prose(1, 8)), (2, "The the TEXT"), (3, None), (4, ""), (5, "É é ünïcode 日本語"), (6, "nowhere"), (7, "a-b_c 1 2"), (7, "tail"), (None, "one")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_awkward_rows(spark, k):
    texts = awkward() + [(30 + i, prose(1, 8 + i % 3)) for i in range(20)]
    assert got(spark, texts, ITEMS, k=k) == brute(texts, ITEMS, k)


@pytest.mark.parametrize("sizes", [(1, 1, 1), (3, 2, 5), (7, 64, 2)])
def test_any_tile_gives_the_same(spark, monkeypatch, sizes):
    for name, size in zip(("DOCS", "ITEMS", "COLUMNS"), sizes):
        monkeypatch.setattr(ranked_search, name, size)
    texts = [(i, prose(i % 25, 12 + i % 9)) for i in range(60)]
    items = [(i, prose(i, 9)) for i in range(12)]
    assert got(spark, texts, items, k=4) == brute(texts, items, 4)


def test_many_blocks_of_items(spark):
    texts = [(i, prose(i % 25, 30)) for i in range(60)]
    items = [(i, prose(i, 12)) for i in range(30)]
    assert got(spark, texts, items, block=2000) == brute(texts, items)


def test_no_partial_sum_reaches_two_to_53():
    weights = [30_000] * 1_000_000
    tiles = ranked_search._tiles([list(range(700_000))], weights)
    products = tiles[0][1]
    assert sum(len(c) for c, _ in products) == 700_000
    for columns, matrix in products:
        assert matrix.sum(axis=0).max() * ranked_search.IMPACT < ranked_search.EXACT and len(columns) <= ranked_search.COLUMNS


def test_weights_beyond_the_bound_are_cut(monkeypatch):
    monkeypatch.setattr(ranked_search, "EXACT", 10_000_000)
    _, products, _ = ranked_search._tiles([[0, 1, 2, 3]], [4, 4, 4, 20])[0]
    assert [c.tolist() for c, _ in products] == [[0, 1], [2], [3]]


def test_a_very_long_text_and_ties_over_tasks(spark):
    long = (100, "alpha1 " * 300_000 + "rare")
    texts = [long] + [(i, "alpha1 beta2 filler") for i in range(40, 0, -1)] + [(200 + i, "other words here") for i in range(50)]
    items = [(1, "alpha1 rare"), (2, "beta2")]
    table = docs(spark, texts).repartition(7, F.col("doc_id"))
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = sorted((tuple(r) for r in ranked_search.search(table, asked).collect()), key=repr)
    assert rows == brute(texts, items)
    assert sorted(r[2] for r in rows if r[0] == 2) == list(range(1, 11))


def test_empty_tables_and_other_columns(spark):
    assert got(spark, [], ITEMS) == [] and got(spark, awkward(), []) == []
    table = docs(spark, awkward()).withColumns({c: F.lit("x") for c in ("id", "item_id", "rank", "score", "terms", "n", "term")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "term", "doc_id")})
    assert sorted((tuple(r) for r in ranked_search.search(table, items).collect()), key=repr) == brute(awkward(), ITEMS)
