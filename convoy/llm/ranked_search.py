"""Ranked lexical search as dense matrix products of integers held in doubles.

A document's impact for a term, times the term's weight, summed over an item's terms, is the score. Items are dealt into tiles,
and each tile keeps only the vocabulary of its items. A tile of documents becomes a dense matrix of impacts over that
vocabulary, and one BLAS product with the tile's weights gives all scores. Products are cut where a partial sum could reach
2^53, so that every sum is an exact integer, and added up in 64 bits. Each tile leaves the best documents of every item, ties
included, by score and id.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import cut

#: Documents and items of a tile, and columns of one product.
DOCS, ITEMS, COLUMNS = 1024, 64, 4096
#: Bytes of terms that one pass over the documents takes, unless a single item has more.
BLOCK = 32 << 20
#: Salts by which the tasks' results are merged before the last ranking.
SALTS = 64
#: Doubles hold every integer up to here.
EXACT = 1 << 53
# An impact never reaches this.
IMPACT = 1_000_000

# Separators become spaces and A-Z lower case; bytes of other scripts stay as they are.
_KEPT = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_TABLE = bytes(b if b in _KEPT else 32 for b in range(256)).lower()
_NO_ID = np.iinfo(np.int64).max


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and digits and of characters beyond ASCII."""
    return text.encode().translate(_TABLE).split() if text else []


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` best documents of every item, as (item_id, rank, id, score long).

    Scores are as the module ``weigh`` and ``impacts`` define them; only those above 0 count. Ranks start at 1, ties go to the
    smaller id, rows without an id come last among equals, and rows that share an id are ranked each by itself. Items that
    share an id, or have none, are one item with the terms of all. Items or documents without terms, and empty tables, give
    no rows. Every pass takes as many items as fit into ``block`` bytes of terms and reads all documents.
    """
    pairs = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).mapInArrow(
        _item_terms, f"item {items.schema[item_col].dataType.simpleString()}, term binary"
    )
    pairs = cut(pairs.distinct())
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks, found = _blocks(pairs, block), None
    for number in range(blocks):
        rows = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        rows = rows.groupBy("item").agg(F.collect_list("term").alias("terms")).collect()
        part = _search(texts, [(r["item"], sorted(map(bytes, r["terms"]))) for r in rows], pairs.schema["item"], k)
        found = part if found is None else found.unionByName(part)
    return found


def _blocks(pairs: DataFrame, limit: int) -> int:
    """Into how many blocks to deal the items, so that none has more bytes of terms unless it is one item."""
    sizes = cut(pairs.groupBy("item").agg(F.sum(F.octet_length("term") + 64).alias("bytes")))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-2 * total // limit)) if total > limit else 1
    while True:
        dealt = sizes.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks))).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        if not dealt.where((F.col("b") > limit) & (F.col("n") > 1)).head(1):
            return blocks
        blocks *= 2


def _item_terms(batches):
    for batch in batches:
        items, places, found = batch.column("item"), [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            own = set(terms(text))
            places += [i] * len(own)
            found += own
        yield pa.RecordBatch.from_arrays([items.take(pa.array(places, pa.int64())), pa.array(found, pa.binary())], ["item", "term"])


def _search(texts: DataFrame, items: list, item_field, k: int) -> DataFrame:
    """One block: count its terms in every document, derive the weights, then score."""
    spark = texts.sparkSession
    vocabulary = sorted({t for _, own in items for t in own})
    place = {t: i for i, t in enumerate(vocabulary)}
    counted = cut(texts.mapInArrow(partial(_count, vocabulary), "id long, n long, terms array<int>, tf array<long>"))
    sums = counted.mapInArrow(partial(_frequencies, len(vocabulary)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = {r["term"]: r["n"] for r in sums.collect()}
    n_docs, length = sums.get(-1, 0), sums.get(-2, 0)
    weights = [weigh(n_docs, sums.get(i, 0)) for i in range(len(vocabulary))]
    tiles = _tiles([[place[t] for t in own] for _, own in items], weights)
    best = counted.where("size(terms) > 0").mapInArrow(
        partial(_score, tiles, n_docs, length, k), "item int, id long, no_id boolean, score long"
    )
    order = [F.desc("score"), F.asc("no_id"), F.asc("id")]
    salted = best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["item", "salt"], ["item"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    schema = f"item int, item_id {item_field.dataType.simpleString()}"
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], schema)
    return salted.join(names, "item").select("item_id", "rank", F.when(~F.col("no_id"), F.col("id")).alias("id"), "score")


def weigh(n_docs: int, df: int) -> int:
    """A term's weight from the documents with any term and those that hold this one."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """What ``tf`` occurrences count in documents of ``n`` terms, out of ``length`` terms in ``n_docs`` documents."""
    m = 100 - 90 + (90 * n * n_docs) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _count(vocabulary, batches):
    """Of every document its number of terms, and which of the vocabulary it holds how often."""
    known = {t: i for i, t in enumerate(vocabulary)}
    for batch in batches:
        sizes, lengths, places, counts = [], [], [], []
        for text in batch.column("text"):
            found = terms(text.as_py())
            own = Counter(map(known.get, found))
            own.pop(None, None)
            sizes.append(len(found))
            lengths.append(len(own))
            places.extend(own.keys())
            counts.extend(own.values())
        ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, kind)) for x, kind in ((places, pa.int32()), (counts, pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), *lists], ["id", "n", "terms", "tf"])


def _frequencies(size, batches):
    """Of a task's documents: how many hold each term, how many have any (-1), and how many terms they have (-2)."""
    df, n_docs, length = np.zeros(size, np.int64), 0, 0
    for batch in batches:
        df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        n = batch.column("n").to_numpy()
        n_docs, length = n_docs + int((n > 0).sum()), length + int(n.sum())
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, -2, *held.tolist()], pa.int32()), pa.array([n_docs, length, *df[held].tolist()], pa.int64())], ["term", "n"]
    )


def _tiles(items: list[list[int]], weights: list[int]) -> list[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """Tiles of items: the first item, and products of (vocabulary columns, weights by column and item).

    No item's weights in one product reach 2^53 when times the greatest impact. Items with terms alike come into one tile.
    """
    tiles = []
    for first in range(0, len(items), ITEMS):
        own = items[first : first + ITEMS]
        columns = sorted({c for terms in own for c in terms if weights[c] > 0})
        products, start = [], 0
        while start < len(columns):
            stop, total = start, 0
            while stop < len(columns) and stop - start < COLUMNS and (total := total + weights[columns[stop]]) * IMPACT < EXACT:
                stop += 1
            stop = max(stop, start + 1)
            part = np.array(columns[start:stop], np.int32)
            matrix = np.zeros((len(part), len(own)))
            for j, held in enumerate(own):
                inside = np.flatnonzero(np.isin(part, held))
                matrix[inside, j] = [weights[c] for c in part[inside]]
            products.append((part, matrix))
            start = stop
        tiles.append((first, products, len(own)))
    return tiles


class _Best:
    """The best documents of every item so far."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def least(self, items: range) -> np.ndarray:
        """The score that a document needs at least, for each item."""
        return np.array([self.held[i][0][-1] if i in self.held and len(self.held[i][0]) == self.k else 1 for i in items], np.int64)

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        parts = zip(self.held[item], (scores, ids, missing)) if item in self.held else ((x,) for x in (scores, ids, missing))
        scores, ids, missing = (np.concatenate(p) for p in parts)
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.held[item] = scores[order], ids[order], missing[order]


def _score(tiles, n_docs, length, k, batches):
    best = _Best(k)
    size = 1 + max((int(c.max()) for _, products, _ in tiles for c, _ in products), default=0)
    columns = np.full(size, -1, np.int32)
    for batch in batches:
        for start in range(0, len(batch), DOCS):
            _score_tile(tiles, n_docs, length, best, columns, batch.slice(start, DOCS))
    rows = [(i, *row) for i, held in best.held.items() for row in zip(*(x.tolist() for x in held))]
    items, scores, ids, missing = zip(*rows) if rows else ([], [], [], [])
    arrays = [pa.array(items, pa.int32()), pa.array(ids, pa.int64()), pa.array(missing, pa.bool_()), pa.array(scores, pa.int64())]
    yield pa.RecordBatch.from_arrays(arrays, ["item", "id", "no_id", "score"])


def _score_tile(tiles, n_docs, length, best: _Best, columns: np.ndarray, docs: pa.RecordBatch) -> None:
    """Scores of a tile of documents for all items, kept where they are among the best."""
    ids = docs.column("id")
    missing, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(_NO_ID).to_numpy()
    held = docs.column("terms").value_lengths().to_numpy()
    rows = np.repeat(np.arange(len(docs)), held)
    places = docs.column("terms").flatten().to_numpy()
    weighted = np.flatnonzero(places < len(columns))
    rows, places = rows[weighted], places[weighted]
    values = impacts(docs.column("tf").flatten().to_numpy()[weighted], docs.column("n").to_numpy()[rows], n_docs, length)
    for first, products, width in tiles:
        scores = np.zeros((len(docs), width), np.int64)
        for part, weights in products:
            columns[part] = np.arange(len(part))
            at = columns[places]
            inside = np.flatnonzero(at >= 0)
            dense = np.zeros((len(docs), len(part)))
            dense[rows[inside], at[inside]] = values[inside]
            scores += (dense @ weights).astype(np.int64)
            columns[part] = -1
        good = scores >= best.least(range(first, first + width))
        for j in np.flatnonzero(good.any(axis=0)):
            chosen = np.flatnonzero(good[:, j])
            best.add(first + int(j), scores[chosen, j], ids[chosen], missing[chosen])
