"""Fingerprints and groups against a plain pairwise search."""

from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from convoy.llm import simhash
from tests.llm.data import awkward, docs, prose


def brute_print(text, words=4):
    found = (text or "").encode().lower().split()
    runs = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    counts = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(runs))


def brute_groups(prints, distance):
    """The group of every place in a list of fingerprints, as the smallest place."""
    group = list(range(len(prints)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = top(i), top(j)
                group[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def test_groups_of_awkward_rows(spark):
    rows = awkward()
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = [brute_print(t) for _, t in rows]
    assert sorted(r.fingerprint % (1 << 64) for r in got) == sorted(prints)
    groups = brute_groups(prints, 4)
    smallest = {}
    for (i, _), g in zip(rows, groups):
        smallest[g] = i if smallest.get(g) is None else smallest[g] if i is None else min(i, smallest[g])
    want = sorted(((i, p, smallest[g]) for (i, _), p, g in zip(rows, prints, groups)), key=repr)
    assert sorted(((r.id, r.fingerprint % (1 << 64), r.component_id) for r in got), key=repr) == want


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 6])
@pytest.mark.parametrize("typical,most", [(512, 2048), (4, 8)])
def test_links_lose_none(spark, monkeypatch, distance, typical, most):
    monkeypatch.setattr(simhash, "TYPICAL", typical)
    monkeypatch.setattr(simhash, "MOST", most)
    draw = random.Random(distance)
    prints = [0, 1, 2**64 - 1, 2**63]
    for _ in range(40):
        base = draw.getrandbits(64)
        prints += [base ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(9))) for _ in range(5)]
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fingerprint long"), distance).collect()
    group = {p: p for p in prints}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    for u, v in ((r.u % (1 << 64), r.v % (1 << 64)) for r in links):
        group[max(top(u), top(v))] = min(top(u), top(v))
    want = brute_groups(prints, distance)
    assert [top(p) for p in prints] == [prints[g] for g in want]


def test_one_of_each(spark):
    rows = [*awkward(), (20, prose(9, 30)), (21, prose(9, 30) + "!"), (22, "one two")]
    table = docs(spark, rows).withColumn("id", F.lit(0)).withColumn("fingerprint", F.lit("x"))
    kept = simhash.one_of_each(table)
    assert kept.columns == table.columns
    prints = [brute_print(t) for _, t in rows]
    groups = brute_groups(prints, 4)
    got = kept.collect()
    assert len(got) == len(set(groups))
    best = {}
    for (i, _), g in zip(rows, groups):
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(best.values())


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.one_of_each(docs(spark, [])).count() == 0


def test_one_large_group(spark):
    base = prose(3, 400).split()
    texts = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in ((i, i % 400) for i in range(600))]
    got = simhash.near_duplicates(docs(spark, texts)).collect()
    prints = [brute_print(t) for _, t in texts]
    assert {r.id: r.component_id for r in got} == dict(enumerate(brute_groups(prints, 4)))
