"""Substring and line dedup against plain loops."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from convoy.llm import line_dedup, substring_dedup
from tests.llm.data import awkward, docs, prose


def brute_words(rows, window=13):
    words = [(t or "").encode().split() for _, t in rows]
    owner = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1) if i is not None else ():
            gram = tuple(w[k : k + window])
            owner[gram] = min(owner.get(gram, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if owner[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def words_of(table, **options):
    rows = substring_dedup.remove_repeats(table, **options).collect()
    return sorted(((r.doc_id, r.dedup.n_words, r.dedup.n_removed, r.dedup.kept) for r in rows), key=repr)


@pytest.mark.parametrize("pack", [1, 2000, 8 << 20])
def test_substring_dedup(spark, monkeypatch, pack):
    monkeypatch.setattr(substring_dedup, "PACK", pack)
    rows = awkward()
    assert words_of(docs(spark, rows).repartition(3)) == brute_words(rows)
    assert words_of(docs(spark, rows), window=2) == brute_words(rows, 2)


def test_substring_dedup_decides_by_words(spark, monkeypatch):
    """With a hash that puts every word on one of two values, unequal windows have equal hashes."""
    monkeypatch.setattr(substring_dedup.zlib, "crc32", lambda w: len(w) % 2, raising=True)
    rows = awkward()[:12]
    from convoy.llm.substring_dedup import _count_bucket, _pack_batches
    import pyarrow as pa

    ids = [(i, t) for i, t in rows if i is not None and t is not None]
    table = pa.table([pa.array([i for i, _ in ids]), pa.array([hash(t) for _, t in ids]), pa.array([t for _, t in ids])], ["id", "text_hash", "text"])
    packs = [b for t in table.to_batches(max_chunksize=2) for b in _pack_batches(13, 3, 1, [t])]
    spans = _count_bucket(13, pa.Table.from_batches(packs)).to_pylist()
    gone = defaultdict(set)
    for s in spans:
        gone[(s["id"], s["text_hash"])].update(range(s["start"], s["stop"]))
    got = sorted((i, len(gone[(i, hash(t))])) for i, t in ids)
    assert got == sorted((i, n) for i, _, n, _ in brute_words(ids))


@pytest.mark.parametrize("split", [1, 3000])
def test_buckets_dealt_anew_give_the_same(spark, monkeypatch, split):
    monkeypatch.setattr(substring_dedup, "PACK", 3000)
    rows = awkward() + [(50 + i, f"{prose(i % 40, 20)} {prose(7, 14)} {prose(i, 20)}") for i in range(120)]
    assert words_of(docs(spark, rows).repartition(3), split=split) == brute_words(rows)


def test_a_common_run_of_words_is_split():
    """A run with a very low hash among different words draws a window of every text into one bucket."""
    import numpy as np
    import pyarrow as pa

    triples = [prose(i, 3) for i in range(4000)]
    run = min(triples, key=lambda t: int(substring_dedup._rolled(substring_dedup._word_hashes(t.encode().split()), 3)[0]))
    texts = [f"{prose(9000 + i, 20)} {run} {prose(50_000 + i, 20)}" for i in range(3000)]
    batch = pa.RecordBatch.from_pydict({"id": range(3000), "text_hash": range(3000), "text": texts})
    packs = pa.Table.from_batches(list(substring_dedup._pack_batches(13, 3, 64, [batch]))).sort_by("bucket")
    sizes = {}
    unpress = substring_dedup.zstandard.ZstdDecompressor()
    for bucket, known, blob in zip(*(packs.column(c).to_pylist() for c in ("bucket", "known", "pack"))):
        sizes[bucket] = sizes.get(bucket, 0) + (0 if known else len(substring_dedup._unframed(blob, unpress)[4]))
    hot = max(sizes, key=sizes.get)
    limit = 3 * int(np.median(list(sizes.values())))
    assert sizes[hot] > 3 * limit
    met = pa.Table.from_batches(list(substring_dedup._meet(13, limit, 64, packs.to_batches())))
    anew = met.filter(pa.compute.is_valid(met.column("pack")))
    parts = {}
    for bucket, blob in zip(anew.column("bucket").to_pylist(), anew.column("pack").to_pylist()):
        parts[bucket] = parts.get(bucket, 0) + len(substring_dedup._unframed(blob, unpress)[4])
    assert len(parts) == 64 and max(parts.values()) < 2 * np.median(list(parts.values()))


def test_substring_dedup_of_a_hot_passage(spark):
    passage = prose(1, 20)
    rows = [(i, f"{prose(100 + i, 5)} {passage} {prose(500 + i, 6)}") for i in range(300)]
    assert words_of(docs(spark, rows)) == brute_words(rows)


def test_substring_dedup_keeps_other_columns(spark):
    table = docs(spark, awkward()).withColumns({"dedup": F.lit(1), "Spans": F.lit(2), "id": F.lit(3), "text_hash": F.lit(4)})
    got = substring_dedup.remove_repeats(table)
    assert got.columns == [*table.columns, "dedup_"]
    assert got.where("dedup_.n_words IS NULL").count() == 0
    assert substring_dedup.remove_repeats(docs(spark, [])).count() == 0


def brute_lines(rows, size=3):
    lines = [t.split("\n") if t is not None else [] for _, t in rows]
    places = defaultdict(list)
    for n, ((i, _), x) in enumerate(zip(rows, lines)):
        for k in range(len(x) - size + 1):
            if "".join(x[k : k + size]).strip():
                places[tuple(x[k : k + size])].append(((i is None, i or 0, k), n))
    gone = defaultdict(set)
    for found in places.values():
        for place, n in found:
            if place > min(found)[0]:
                gone[n].update(range(place[2], place[2] + size))
    return sorted(
        ((i, len(x), len(gone[n]), None if t is None else "\n".join(l for k, l in enumerate(x) if k not in gone[n]))
         for n, ((i, t), x) in enumerate(zip(rows, lines))), key=repr)


def test_line_dedup(spark):
    block = "\n".join(prose(i, 6) for i in range(5))
    rows = [
        (1, block),
        (2, f"intro\n{block}\noutro"),
        (3, None),
        (4, ""),
        (5, "a\nb"),
        (6, "same\n" * 6 + "end"),
        (7, "\n\n\n\n"),
        (8, f"x\n{block}"),
        (8, f"x\n{block}"),
        (None, block),
        (9, "\n".join(block.split("\n")[1:4])),
        (10, "fresh\nlines\nonly\nhere"),
    ]
    got = line_dedup.remove_repeats(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.dedup.n_lines, r.dedup.n_removed, r.dedup.kept) for r in got), key=repr) == brute_lines(rows)


def test_line_dedup_keeps_other_columns(spark):
    table = docs(spark, awkward()).withColumns({"starts": F.lit(1), "dedup": F.lit(2), "id": F.lit(3)})
    assert line_dedup.remove_repeats(table).columns == [*table.columns, "dedup_"]
    assert line_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_few_rows_of_a_batch_are_python_objects_at_a_time():
    """However many rows a batch has, texts and what stays of them leave the worker in small parts."""
    import pyarrow as pa

    from convoy.llm import common, line_dedup, toxicity

    n = 3 * common.AT_ONCE + 7
    texts = pa.array([None if i % 9 == 0 else f"a{i}\nb\nc\nd" for i in range(n)])
    starts = pa.array([[1] if i % 2 else None for i in range(n)], pa.list_(pa.int32()))
    parts = list(line_dedup._kept(3, iter([(texts, starts), (texts[:0], starts[:0])])))
    assert max(map(len, parts)) <= common.AT_ONCE and sum(map(len, parts)) == n
    kept = [r["kept"] for part in parts for r in part.to_pylist()]
    assert kept == [None if i % 9 == 0 else f"a{i}" if i % 2 else f"a{i}\nb\nc\nd" for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array([i % 2 for i in range(n)], pa.int32()), texts], ["label", "text"])
    held = list(toxicity._held([" a1 "], iter([batch])))
    assert max(map(len, held)) <= common.AT_ONCE and sum(map(len, held)) == n
