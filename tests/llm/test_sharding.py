"""Shards: the law of sizes, groups, slots, and awkward rows."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from convoy.llm import queries, sharding
from tests.llm.data import awkward, docs, prose

SF = "/root/testdata/sf0.01"


def checked(rows, texts, shards):
    """Sizes, checksums and slots hold, every row is placed once, and equal texts share a shard unless they are many."""
    assert Counter(r.id for r in rows) == Counter(i for i, _ in texts)
    by_shard, sizes = defaultdict(list), Counter()
    for r in rows:
        by_shard[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and set(by_shard) <= set(range(shards))
    known = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert known == Counter((r.id, r.size, r.text_crc32) for r in rows)
    return [sizes[s] for s in range(shards)]


def test_awkward_rows(spark):
    texts = awkward()
    rows = sharding.place(docs(spark, texts), 2).collect()
    checked(rows, texts, 2)
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32, r.size].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_sizes_of_the_sample(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op11_sharding(spark, SF).withColumnRenamed("doc_id", "id").collect()
    sizes = checked(rows, [(r.doc_id, r.text) for r in table.collect()], 16)
    assert max(sizes) - min(sizes) < 0.03 * np.mean(sizes)
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 2 and len(counts) == 16


def test_hot_group_is_split_and_the_rest_stays_whole(spark):
    texts = [(i, "the same text in a third of all rows") for i in range(700)] + [(700 + i, prose(i % 500, 7)) for i in range(1400)]
    rows = sharding.place(docs(spark, texts).repartition(5), 8).collect()
    sizes = checked(rows, texts, 8)
    assert max(sizes) - min(sizes) < 0.04 * np.mean(sizes)
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32].add(r.shard)
    assert sorted(map(len, homes.values()))[-2:] == [1, 8]


@pytest.mark.parametrize("heavy", [1e-9, 10.0])
def test_cells_balance_as_the_driver_does(spark, monkeypatch, heavy):
    """All groups on the driver, or all in cells."""
    monkeypatch.setattr(sharding, "HEAVY", heavy)
    monkeypatch.setattr(sharding, "CELL", 150)
    texts = [(i, prose(i, 5 + (i * 7) % 60)) for i in range(1200)]
    sizes = checked(sharding.place(docs(spark, texts), 4).collect(), texts, 4)
    assert max(sizes) - min(sizes) < 0.02 * np.mean(sizes)


def test_the_same_rows_get_the_same_shards(spark):
    table = docs(spark, [(i, prose(i % 90, 9)) for i in range(300)])
    first, second = (sorted(tuple(r) for r in sharding.place(table, 5).collect()) for _ in range(2))
    assert first == second


def test_greedy_takes_the_highest_dot_product():
    room = np.array([[1.0, 0.2, 1.0], [0.6, 0.9, 0.6]])
    assert sharding._greedy(room.copy(), np.array([[0.5, 0.0, 0.1], [0.0, 0.4, 0.0]]), ["a", "b"]).tolist() == [0, 1]


def test_empty_tables_long_texts_and_clashing_names(spark, tmp_path):
    empty = docs(spark, [])
    assert sharding.place(empty).count() == 0
    texts = [(1, "word " * 400_000), (2, "x" * 2_000_000), (3, None)]
    checked(sharding.place(docs(spark, texts), 2).collect(), texts, 2)
    clashing = docs(spark, awkward()).withColumns({c: F.lit(1) for c in ("shard", "slot", "size", "group", "at", "part")})
    sharding.write_shards(clashing, f"{tmp_path}/shards", 3)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(set(back.columns) - set(clashing.columns)) == ["shard_"]
    assert sorted(map(repr, back.select(clashing.columns).collect())) == sorted(map(repr, clashing.collect()))
