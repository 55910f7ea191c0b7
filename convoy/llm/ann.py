"""Nearest neighbours by inner product, with collision-counting hashing.

Vectors get one more component, which makes their lengths equal, so that the largest inner product is the smallest distance.
Each hash is one projection, and its index is the sorted array of all projected values, cut into pages of equal numbers of
vectors. A query opens a window around its own value in every array, in whole pages; a vector that lies in enough windows is a
candidate and is verified with the original vectors, in the end in double precision. The windows then widen, over the same
arrays, to where the nearest candidates say that hardly any neighbour is left: projections are normal, so the chance that a
vector of some distance lies in too few windows follows from that distance alone, whatever the data.

Vectors are dealt to cells by the nearest of some pivots and by length, and large cells are split into blocks. A cell whose every vector must
be worse than what a bounded sample already offers a query is not opened for it. Each pair of a block and a block of queries
is a task, which builds its index once, so the index is never in one place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import cut, few

#: Vectors of a block at least and at most, and their bytes at most; queries of a block have the same limits.
LEAST, MOST, BYTES = 8192, 65_536, 64 << 20
#: Vectors of the sample that bounds results from below, its bytes, and pivots, at most.
SAMPLE, SAMPLE_BYTES, PIVOTS = 2048, 8 << 20, 1024
#: Lengths of a band differ by less than this factor.
BAND = 1.5
#: Pages of a sorted array, so that a vector's page is one byte.
PAGES = 256


@dataclass(frozen=True)
class Settings:
    """How the index searches; the defaults are meant for vectors of some hundred components.

    A candidate lies in the share ``threshold`` of all windows. The first windows hold the share ``first`` of a block; they
    widen by ``widen`` until there are as many candidates as neighbours asked for, and then at once until a neighbour is missed
    with a chance of ``miss`` at most.
    """

    projections: int = 64
    threshold: float = 0.9
    first: float = 0.5
    widen: float = 1.2
    miss: float = 0.04
    seed: int = 42


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that can take part, as (id, v array<double>): no null id, vector or component, all finite, not all zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    settings: Settings = Settings(),
    block: int | None = None,
) -> DataFrame:
    """The ``k`` nearest vectors found for every query, as (query_id, rank, id, score).

    A query's own id is no candidate. Ranks start at 1; ties go to the smaller id. Unusable rows take no part, and neither do
    vectors of another length than most have. Repeated rows count once. If there are fewer candidates than ``k``, all are
    returned. An empty table gives an empty result. ``block`` is the number of vectors in a block, chosen by their number
    and size unless given.
    """
    index = usable(vectors, id_col, vector_col).distinct()
    asked = usable(queries, id_col, vector_col).distinct()
    lengths = index.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    out = "query_id long, id long, score double"
    if not lengths:
        return _ranked(index.sparkSession.createDataFrame([], out), k)
    common = max(lengths, key=lambda r: (r["n"], -r["d"]))
    n, dim = common["n"], common["d"]
    most = max(1, min(MOST, BYTES // (8 * dim)))
    size = block or min(most, max(LEAST, n // 256))
    index, asked = index.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    sample = index.orderBy(F.xxhash64("id", "v"), "id").limit(max(k + 1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))).collect()
    sample_ids, sample = np.array([r["id"] for r in sample]), np.array([r["v"] for r in sample])
    pivots = sample[: max(1, min(PIVOTS, len(sample), -(-n // size)))]

    dealt = cut(index.mapInArrow(partial(_deal, pivots), "id long, v array<double>, pivot int, band int, far double, long double"))
    cells = dealt.groupBy("pivot", "band").agg(F.max("far").alias("far"), F.max("long").alias("long"), F.count(F.lit(1)).alias("n"))
    cells = sorted(cells.collect())
    many = [-(-r["n"] // size) for r in cells]
    starts = np.cumsum([0, *many])[:-1].tolist()
    shown = np.array([(r["pivot"], r["far"], r["long"]) for r in cells])
    open_for = partial(_open_for, k, sample_ids, sample, pivots, shown, starts, many)
    right = asked.mapInArrow(open_for, "id long, v array<double>, least double, block int")
    q_blocks = max(1, -(-asked.count() // most))
    right = right.withColumn("asked", F.pmod(F.xxhash64("id", "v"), F.lit(q_blocks)).cast("int"))
    numbers = [(r["pivot"], r["band"], start, m) for r, start, m in zip(cells, starts, many)]
    numbers = index.sparkSession.createDataFrame(numbers, "pivot int, band int, start int, many int")
    left = dealt.join(F.broadcast(numbers), ["pivot", "band"])
    block_of = (F.col("start") + F.pmod(F.xxhash64("id", "v"), "many")).cast("int").alias("block")
    left = left.select("id", "v", block_of, F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("asked"))
    keys = ["block", "asked"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(partial(_search_block, dim, k, settings), out)
    # vectors below the sample's bound are left out of what is found, so those that set it belong to it, or some would be missing
    offered = asked.mapInArrow(partial(_offered, k, sample_ids, sample), out)
    return _ranked(found.unionByName(offered).repartition("query_id").distinct(), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def _vectors(column, dim: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _deal(pivots, batches):
    """The nearest pivot of every vector and the distance to it, the band of its length, and the length."""
    squares = (pivots * pivots).sum(axis=1)
    for batch in batches:
        v = _vectors(batch.column("v"), pivots.shape[1])
        pivot, lengths = np.argmin(squares - 2 * (v @ pivots.T), axis=1), np.linalg.norm(v, axis=1)
        band = np.floor(np.log(lengths) / math.log(BAND))
        far = np.linalg.norm(v - pivots[pivot], axis=1)
        columns = [pa.array(pivot, pa.int32()), pa.array(band.astype(np.int32)), pa.array(far), pa.array(lengths)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["id", "v", "pivot", "band", "far", "long"])


def _open_for(k, sample_ids, sample, pivots, cells, starts, many, batches):
    """Of every query the least score that can be among its best, by the sample, and the blocks that may hold such vectors."""
    pivot, far, longest, starts, many = cells[:, 0].astype(int), cells[:, 1], cells[:, 2], np.array(starts), np.array(many)
    for batch in batches:
        ids, q = batch.column("id").to_numpy(), _vectors(batch.column("v"), sample.shape[1])
        norms = np.linalg.norm(q, axis=1)
        scores = q @ sample.T
        scores[ids[:, None] == sample_ids] = -np.inf
        least = np.partition(scores, -k, axis=1)[:, -k] if len(sample) >= k else np.full(len(q), -np.inf)
        least = least - 1e-9 * norms * longest.max()
        bound = np.minimum(norms[:, None] * longest, q @ pivots[pivot].T + norms[:, None] * far)
        query, cell = np.nonzero(bound + 1e-9 * norms[:, None] * longest >= least[:, None])
        query, place = np.repeat(query, many[cell]), np.repeat(starts[cell], many[cell])
        place = place + np.concatenate([np.arange(m) for m in many[cell]]) if len(cell) else place
        columns = [pa.array(least[query]), pa.array(place.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(query)).columns, *columns], ["id", "v", "least", "block"])


def _offered(k, sample_ids, sample, batches):
    """The ``k`` best vectors of the sample for every query."""
    longest = np.linalg.norm(sample, axis=1).max()
    for batch in batches:
        for part in few(batch):
            ids, q, rows = part.column("id").to_numpy(), _vectors(part.column("v"), sample.shape[1]), []
            for query, vector, rough in zip(ids, q, q @ sample.T):
                others = np.flatnonzero(sample_ids != query)
                rough = rough[others]
                if len(others) > k:
                    least = np.partition(rough, -k)[-k] - 1e-9 * np.linalg.norm(vector) * longest
                    others = others[rough >= least]
                # summed as in the index, so that a vector that both find has one score
                scores = (sample[others] * vector).sum(axis=1)
                best = np.lexsort((sample_ids[others], -scores))[:k]
                rows.append((np.full(len(best), query), sample_ids[others[best]], scores[best]))
            columns = [np.concatenate(c) for c in zip(*rows)] if rows else [[], [], []]
            types = [pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["query_id", "id", "score"])


def _search_block(dim, k, settings, left: pa.Table, right: pa.Table) -> pa.Table:
    names = ["query_id", "id", "score"]
    if not len(left) or not len(right):
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names)
    ids, v = left.column("id").to_numpy(), _vectors(left.column("v"), dim)
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    query_ids, q, least = right.column("id").to_numpy(), _vectors(right.column("v"), dim), right.column("least").to_numpy()
    index, rows = Index(v, settings), []
    for i in np.lexsort((least, query_ids)):
        found, scores = index.nearest(q[i], k, ids != query_ids[i], least[i])
        best = np.lexsort((ids[found], -scores))[:k]
        rows.append((np.full(len(best), query_ids[i]), ids[found[best]], scores[best]))
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*rows)], names)


def _windows_per_distance(projections: int, least: int, miss: float) -> float:
    """Half a window, as a multiple of a distance, in which a vector so far away collides in under ``least`` of the
    projections with a chance of ``miss``."""
    low, high = 0.0, 1.0
    for _ in range(60):
        rate = (low + high) / 2
        few = sum(math.comb(projections, n) * rate**n * (1 - rate) ** (projections - n) for n in range(least))
        low, high = (rate, high) if few > miss else (low, rate)
    return NormalDist().inv_cdf(min((1 + high) / 2, 1 - 1e-12))


class Index:
    """The sorted arrays of projected values of one block: each vector's page, and where pages begin and end."""

    def __init__(self, v: np.ndarray, settings: Settings):
        self.settings, self.v, self.n = settings, v, len(v)
        self.rough = v.astype(np.float32)
        squares = (v * v).sum(axis=1)
        self.longest = float(np.sqrt(squares.max()))
        rest = np.sqrt(np.maximum(0, self.longest**2 - squares))
        self.least = max(1, math.ceil(settings.threshold * settings.projections))
        self.per_distance = _windows_per_distance(settings.projections, self.least, settings.miss)
        draw = np.random.default_rng(settings.seed)
        self.axes = draw.standard_normal((v.shape[1], settings.projections))
        values = (v @ self.axes + rest[:, None] * draw.standard_normal(settings.projections)).T.copy()
        order = np.argsort(values, axis=1, kind="stable")
        page = -(-self.n // PAGES)
        # padded, so that eight counts of one byte can be added as one number
        self.pages = np.zeros((len(values), -(-self.n // 8) * 8), np.uint8)
        np.put_along_axis(self.pages, order, (np.arange(self.n) // page).astype(np.uint8)[None, :], axis=1)
        self.moved, self.inside = np.empty_like(self.pages), np.empty(self.pages.shape, bool)
        values = np.take_along_axis(values, order, axis=1)
        # half a window that holds the share ``first`` of the block in the middle of an array, on average
        low, high = np.quantile(values, [0.5 - settings.first / 2, 0.5 + settings.first / 2], axis=1)
        self.half = max(float(np.mean(high - low)) / 2, 1e-9 * self.longest)
        # the ends of all pages as one sorted array, a step for every projection
        firsts, lasts = values[:, ::page], values[:, np.minimum(np.arange(page - 1, self.n + page - 1, page), self.n - 1)]
        self.last = firsts.shape[1] - 1
        self.reach = 1.01 * float(np.abs(values).max()) + 1e-9 * self.longest
        self.steps, self.base = 4 * self.reach * np.arange(len(values)), (self.last + 1) * np.arange(len(values))
        self.firsts, self.lasts = (firsts + self.steps[:, None]).ravel(), (lasts + self.steps[:, None]).ravel()
        self.verified = self.opened = 0

    def nearest(self, vector: np.ndarray, k: int, others: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the candidates that may be among the ``k`` best, and score ``least`` or more."""
        norm = float(np.linalg.norm(vector))
        values = (vector * (self.longest / norm)) @ self.axes  # of the common length, so nothing for the extra component
        error = 1e-6 * math.sqrt(len(vector)) * norm * self.longest  # of products in single precision
        narrow = vector.astype(np.float32)
        half, seen, found, rough = self.half, None, np.zeros(0, np.int64), np.zeros(0, np.float32)
        while True:
            inside, whole = self.collide(values, half)
            inside &= others
            fresh = np.flatnonzero(inside if seen is None else inside & ~seen)
            found, rough, seen = np.concatenate([found, fresh]), np.concatenate([rough, self.rough.take(fresh, axis=0) @ narrow]), inside
            kth = float(np.partition(rough, -k)[-k]) - error if len(found) >= k else -math.inf
            safe = self.safe(max(kth, least) / norm)
            if whole or safe <= half:
                break
            half = min(safe, half * self.settings.widen) if kth == -math.inf else safe
        # queries need windows alike, so the next one starts near them
        self.half = 0.8 * self.half + 0.2 * max(min(safe, half), 1e-9 * self.longest)
        self.verified, self.opened = self.verified + len(found), self.opened + self.n
        found = found[rough >= max(kth, least) - 2 * error]
        # summed row by row, so that equal vectors get equal scores
        return found, (self.v[found] * vector).sum(axis=1)

    def safe(self, score: float) -> float:
        """Half the window in which vectors of this inner product with the query's direction, or more, are rarely missed."""
        if score == -math.inf:
            return math.inf
        square = 2 * self.longest * (self.longest - score) + 1e-9 * self.longest**2
        return self.per_distance * math.sqrt(max(square, 0.0))

    def collide(self, values: np.ndarray, half: float) -> tuple[np.ndarray, bool]:
        """Which vectors collide in enough windows, and whether every window holds the whole block."""
        # no window reaches the next projection's values
        starts = self.steps + np.minimum(np.maximum(values - half, -self.reach), self.reach)
        ends = self.steps + np.maximum(np.minimum(values + half, self.reach), -self.reach)
        low = np.minimum(self.lasts.searchsorted(starts) - self.base, self.last)
        high = np.maximum(self.firsts.searchsorted(ends, "right") - 1 - self.base, low)
        # a page left of the window wraps around to a large number
        np.subtract(self.pages, low.astype(np.uint8)[:, None], out=self.moved)
        np.less_equal(self.moved, (high - low).astype(np.uint8)[:, None], out=self.inside)
        return self._tally() >= self.least, bool((low == 0).all() and (high == self.last).all())

    def _tally(self) -> np.ndarray:
        """In how many windows each vector lies."""
        total = np.zeros(self.n, np.int32)
        for start in range(0, len(self.inside), 255):
            eights = np.add.reduce(self.inside[start : start + 255].view(np.uint64), axis=0)
            total += eights.view(np.uint8)[: self.n]
        return total
