"""Contamination against a plain search for every window."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from convoy.llm import decontaminate
from tests.llm.data import awkward, docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, span=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for k in range(max(1, len(w) - span + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + span]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w, hit, found = words_of(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def items():
    passage = prose(1, 30)
    return [
        (1, passage),
        (20, "  ".join(passage.upper().split()[5:20])),
        (3, "tail of IT"),
        (4, "the the"),
        (5, None),
        (6, " ?! "),
        (7, prose(77, 50)),
        (None, prose(4, 15)),
        (8, prose(4, 12)),
        (8, prose(5, 11)),
        (9, "one"),
        (10, "ünïcode ÉTÉ 日本語"),
        (11, prose(99, 10)),
    ]


def got(spark, rows, benchmark, **options):
    table = docs(spark, rows).withColumns({"words": F.lit(1), "id": F.lit(2), "start": F.lit(3)})
    bench = spark.createDataFrame(benchmark, ITEMS).withColumn("gram", F.lit(1))
    found = decontaminate.contamination(table, bench, **options).collect()
    return sorted(((r.id, r.n_words, r.n_hit, list(r.items)) for r in found), key=repr)


@pytest.mark.parametrize("small", [10**6, 0])
@pytest.mark.parametrize("span", [10, 3, 1])
def test_contamination(spark, small, span):
    rows = [*awkward(), (40, prose(77, 50)), (41, f"x {prose(99, 10)}"), (42, prose(99, 9)), (43, "TAIL/of-it tail of it")]
    assert got(spark, rows, items(), small=small, span=span) == brute(rows, items(), span)


@pytest.mark.parametrize("small", [10**6, 0])
def test_empty_tables(spark, small):
    assert got(spark, [], items(), small=small) == []
    assert got(spark, awkward(), [], small=small) == brute(awkward(), [])


def test_no_python_in_the_plan(spark):
    """The main path is made of DataFrame functions only."""
    rows = docs(spark, awkward())
    plan = decontaminate._hits_in_place(
        rows.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("doc_text")),
        F.broadcast(spark.range(1).select(F.col("id").alias("print"))),
        F.broadcast(spark.range(1).select(F.col("id").cast("string").alias("gram"))),
        10,
        [3],
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan
