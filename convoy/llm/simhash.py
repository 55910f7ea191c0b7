"""Near duplicates by SimHash: fingerprints, and a binary trie joined with itself.

The trie of all fingerprints is walked in node pairs. A pair carries the number of bits in which its two paths differ and
is dropped once that number exceeds the budget. The first levels of the walk are rows: a fingerprint goes to every pair
that its own node forms with a node within the budget, keyed by the two paths. Pairs with too many fingerprints take more
levels as rows; the levels below are walked inside a task.

Walking one trie with the whole budget from the root would keep most pairs until deep levels. Bits are therefore cut into
blocks, and the trie is walked once for every block, each time with that block first and a smaller budget inside it. The
budgets of the blocks add up to one less than would let a pair slip through all of them, so no pair is lost.
"""

from __future__ import annotations

import itertools
import math
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, few, fresh
from convoy.llm.components import connected

BITS = 64
#: Fingerprints that a node pair should hold on average when its subtrees are walked in a task, and at most.
TYPICAL, MOST = 512, 2048
#: Levels that a pair with too many fingerprints takes at a time.
STEP = 4


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint of every text, as (id, fingerprint long, text_hash long), a row for every row of ``docs``.

    Text is lower-cased in A-Z and split at ASCII white space. Every run of ``words`` words, repeats included, is hashed by
    XXH64 with seed 42; a bit of the fingerprint is 1 if over half the hashes have it. A text of fewer words is one run.
    A null text counts as empty, and a text without words has fingerprint zero.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    schema = source.select("id", F.lit(0).cast("long").alias("fingerprint"), "text_hash").schema
    return source.mapInArrow(partial(_fingerprint_batches, words), schema)


def _fingerprint_batches(words, batches):
    for batch in batches:
        marks = [_fingerprint(t, words) for part in few(batch.column("text")) for t in part.to_pylist()]
        column = pa.array(np.array(marks, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), column, batch.column("text_hash")], ["id", "fingerprint", "text_hash"]
        )


def _fingerprint(text: str | None, words: int) -> int:
    """bytes.lower() and bytes.split() know ASCII only, which is what the definition asks for."""
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    runs = max(1, len(found) - words + 1)
    last = ends[min(words, len(found)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[:runs].tolist(), last.tolist())], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for i in range(0, runs, 1 << 16):
        octets = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > runs, bitorder="little").view(np.uint64)[0])


def blocks(distance: int) -> list[tuple[int, int, int]]:
    """(first bit, width, budget) of the blocks for links of up to ``distance`` bits."""
    n = min(3, distance + 1)
    base, extra = divmod(distance + 1, n)
    out, at = [], 0
    for i in range(n):
        width = BITS // n + (i < BITS % n)
        out.append((at, width, base - 1 + (i < extra)))
        at += width
    return out


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """Links that connect all distinct fingerprints of up to ``distance`` differing bits, as (u, v).

    Within a node pair only a spanning forest of its links is returned, so that a dense cluster makes no quadratic output.
    Null fingerprints take no part.
    """
    distinct = distinct.select("fingerprint").where("fingerprint IS NOT NULL")
    n = distinct.count()
    parts = blocks(distance)
    depth = max(0, min(math.ceil(math.log2(max(1, n) / TYPICAL)), min(width for _, width, _ in parts)))
    rows = None
    for i, (first, width, budget) in enumerate(parts):
        turned = _turned(F.col("fingerprint"), first)
        masks = [sum(1 << b for b in bits) for k in range(budget + 1) for bits in itertools.combinations(range(depth), k)]
        own = F.shiftrightunsigned(turned, BITS - depth) if depth else F.lit(0).cast("long")
        part = (
            distinct.select(F.lit(i).alias("block"), F.lit(depth).alias("depth"), own.alias("own"), turned.alias("bits"))
            .withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
            .withColumn("other", F.col("own").bitwiseXOR(F.col("mask")))
            .select("block", "depth", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "bits")
        )
        rows = part if rows is None else rows.unionByName(part)
    rows = _deepened(rows, parts, distance)
    keys = ["block", "depth", "low", "high"]
    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys, "bits")
        .mapInArrow(partial(_walk_batches, parts, distance), "u long, v long")
    )


def _turned(bits, by: int):
    """``bits`` turned left, so that bit ``by`` from the top comes first."""
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, BITS - by)) if by else bits


def _deepened(rows: DataFrame, parts, distance: int) -> DataFrame:
    """Walk more levels for pairs of over ``MOST`` fingerprints; such a pair cannot outlast 64 levels."""
    keys = ["block", "depth", "low", "high"]
    done = None
    while True:
        crowded = rows.groupBy(*keys).count().where((F.col("count") > MOST) & (F.col("depth") <= BITS - STEP)).select(*keys)
        crowded = cut(crowded)
        if crowded.isEmpty():
            return rows if done is None else done.unionByName(rows)
        calm = rows.join(crowded, keys, "left_anti").select(*keys, "bits")
        done = calm if done is None else done.unionByName(calm)
        own = F.expr(f"shiftrightunsigned(shiftleft(bits, depth), {BITS - STEP})")
        mine = F.expr("CASE WHEN depth = 0 THEN 0L ELSE shiftrightunsigned(bits, 64 - depth) END")
        budget = F.lit(distance)
        for i, (_, width, most) in enumerate(parts):
            budget = F.when((F.col("block") == i) & (F.col("depth") + STEP <= width), most).otherwise(budget)
        down = (
            rows.join(crowded, keys)
            .withColumn("mine", mine)
            .withColumn("theirs", F.expr("low ^ high ^ mine"))
            .withColumn("own", own)
            .withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in range(1 << STEP)])))
            .where(F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) + F.bit_count("mask") <= budget)
            .withColumn("a", F.shiftleft("mine", STEP).bitwiseOR(F.col("own")))
            .withColumn("b", F.shiftleft("theirs", STEP).bitwiseOR(F.col("own").bitwiseXOR(F.col("mask"))))
        )
        rows = cut(
            down.select(
                "block",
                (F.col("depth") + STEP).alias("depth"),
                F.least("a", "b").alias("low"),
                F.greatest("a", "b").alias("high"),
                "bits",
            )
        )


def _walk_batches(parts, distance, batches):
    """Walk every node pair. Rows arrive sorted by pair; one pair and one batch are held at a time."""
    keys = ("block", "depth", "low", "high")
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*keys, "bits")], axis=1)
        if not len(rows):
            continue
        if held:
            rows = np.concatenate([*held, rows])
        cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist()]
        yield from _forest(rows, bounds, parts, distance)
        held = [rows[bounds[-1] :].copy()]
    if held:
        rows = held[0]
        yield from _forest(rows, [0, len(rows)], parts, distance)


def _forest(rows, bounds, parts, distance):
    us, vs = [], []
    for start, end in zip(bounds[:-1], bounds[1:]):
        block, depth, low, high = (int(x) for x in rows[start, :4])
        bits = rows[start:end, 4].astype(np.uint64) if end - start > 1 else None
        if bits is None:
            continue
        i, j = _walk(bits, depth, low, high, *parts[block][1:], distance)
        if len(i):
            back = parts[block][0]
            old = bits if not back else (bits >> np.uint64(back)) | (bits << np.uint64(BITS - back))
            u, v = _spanning(i, j, old.view(np.int64))
            us.append(u)
            vs.append(v)
    if us:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])


def _walk(bits, depth, low, high, width, budget, distance):
    """Positions (i, j) of the links of one node pair."""
    empty = np.zeros(0, np.int64)
    if low == high:
        todo = [(0, len(bits), 0, len(bits), depth, 0)]
    else:
        path = bits >> np.uint64(BITS - depth)
        on_low = path == np.uint64(low % (1 << 64))
        order = np.argsort(~on_low, kind="stable")
        if not on_low.any() or on_low.all():
            return empty, empty
        bits, n = bits[order], int(on_low.sum())
        lows = np.argsort(bits[:n])
        highs = np.argsort(bits[n:]) + n
        order = order[np.concatenate([lows, highs])]
        bits = bits[np.concatenate([lows, highs])]
        todo = [(0, n, n, len(bits), depth, (low ^ high).bit_count())]
    if low == high:
        order = np.argsort(bits)
        bits = bits[order]
    inside = np.uint64(((1 << width) - 1) << (BITS - width))
    found_i, found_j = [], []
    while todo:
        a0, a1, b0, b1, level, differ = todo.pop()
        if differ > (budget if level <= width else distance) or a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) <= 1 << 15 or level == BITS:
            x = bits[a0:a1, None] ^ bits[None, b0:b1]
            near = (np.bitwise_count(x) <= distance) & (np.bitwise_count(x & inside) <= budget)
            i, j = np.nonzero(near)
            i, j = i + a0, j + b0
            keep = i < j if a0 == b0 else slice(None)
            found_i.append(i[keep])
            found_j.append(j[keep])
            continue
        shift = np.uint64(BITS - 1 - level)
        a = a0 + int(np.searchsorted((bits[a0:a1] >> shift) & np.uint64(1), 1))
        b = b0 + int(np.searchsorted((bits[b0:b1] >> shift) & np.uint64(1), 1))
        todo += [(a0, a, b0, b, level + 1, differ), (a, a1, b, b1, level + 1, differ), (a0, a, b, b1, level + 1, differ + 1)]
        if a0 != b0:
            todo.append((a, a1, b0, b, level + 1, differ + 1))
    if not found_i:
        return empty, empty
    return order[np.concatenate(found_i)], order[np.concatenate(found_j)]


def _spanning(i, j, values):
    """Edges from every linked value to the smallest one it is connected with."""
    order = np.argsort(values)
    place = np.empty(len(values), np.int64)
    place[order] = np.arange(len(values))
    i, j, values = place[i], place[j], values[order]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[i], label[j])
        lower = label.copy()
        np.minimum.at(lower, i, low)
        np.minimum.at(lower, j, low)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text"):
    """Groups of near duplicates, as (id, fingerprint long, text_hash long, root long, component_id), a row for every row.

    Two texts are linked if their fingerprints differ in at most ``distance`` bits. ``component_id`` is the smallest id of the
    group, over all rows reachable by links, and ``root`` the fingerprint of that row. Rows without an id keep their
    links; a group of only such rows has a null ``component_id``. Repeated rows stay repeated. An empty table gives an
    empty result.
    """
    return _grouped(cut(fingerprints(docs, words, id_col, text_col)), distance)


def _grouped(marked: DataFrame, distance: int) -> DataFrame:
    """Fingerprints are ordered by their smallest id, so that the first of a group names the group's smallest id itself."""
    first = marked.groupBy("fingerprint").agg(F.min("id").cast("long").alias("first_id"))
    order = F.struct(F.isnull("first_id").alias("nameless"), F.coalesce("first_id", F.lit(0)).alias("first_id"), "fingerprint")
    classes = cut(first.select("fingerprint", order.alias("node")))
    edges = links(classes, distance)
    for end in ("u", "v"):
        named = classes.select(F.col("fingerprint").alias(end), F.col("node").alias(f"{end}_node"))
        edges = edges.join(named, end).drop(end)
    trees = connected(edges.select(F.col("u_node").alias("u"), F.col("v_node").alias("v")))
    classes = classes.join(trees, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("root"))
    smallest = F.when(~F.col("root.nameless"), F.col("root.first_id")).alias("component_id")
    classes = classes.select("fingerprint", F.col("root.fingerprint").alias("root"), smallest)
    return marked.join(classes, "fingerprint").select("id", "fingerprint", "text_hash", "root", "component_id")


def one_of_each(docs: DataFrame, words: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text"):
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Of several rows with that id the one with the smallest text hash stays, and of equal rows a single one. A row without
    an id stays only if no row of its group has one.
    """
    marked = cut(fingerprints(docs, words, id_col, text_col))
    best = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "text_hash")).alias("best")
    keepers = _grouped(marked, distance).groupBy("root").agg(best).select("best.id", "best.text_hash")
    kept = _matching(docs, keepers, id_col, text_col, "left_semi")
    repeated = cut(marked.groupBy("id", "text_hash").count().where("count > 1").select("id", "text_hash"))
    if repeated.isEmpty():
        return kept
    once = _matching(kept, repeated, id_col, text_col, "left_anti")
    return once.unionByName(_matching(kept, repeated, id_col, text_col, "left_semi").dropDuplicates([id_col, text_col]))


def _matching(docs, marks, id_col, text_col, how):
    marks = marks.select(F.col("id").alias(fresh(docs, "id")), F.col("text_hash").alias(fresh(docs, "text_hash")))
    mark_id, mark_hash = (marks[c] for c in marks.columns)
    return docs.join(marks, docs[id_col].eqNullSafe(mark_id) & (F.xxhash64(docs[text_col]) == mark_hash), how)
