"""Shards of equal size by vector bin packing: bytes, tokens and rows are balanced together.

Rows with equal texts are a group with a demand in bytes, tokens and rows, each as a share of one shard's capacity. Groups are
placed one after the other, large ones first, each into the shard where the dot product of its demand with the room left is
highest. Groups of some size are few, whatever the input, and are placed on the driver. All others are dealt by a hash into
cells, and each cell fills its own part of the room that the large ones left, in a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import cut, fresh

#: Share of a shard from which a group is placed on the driver. At most 3 * shards / HEAVY groups reach it.
HEAVY = 1 / 256
#: Larger groups than WHOLE shards are split into pieces of about PIECE shards.
WHOLE, PIECE = 1 / 2, 1 / 8
#: Groups of a cell, on average.
CELL = 16_384
WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS = ("bytes", "tokens", "rows")


def place(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    tokens: Column | None = None,
) -> DataFrame:
    """A shard and a slot for every row, as (id, row, size, tokens, text_crc32, shard, slot).

    ``size`` is the text's bytes in UTF-8 plus 1, a null text counting as an empty one. ``tokens`` are words between white
    space unless given. ``row`` is a struct of the columns named by ``carry``, null if there are none. Rows of a shard have
    the slots from 0 on, without gaps. Equal texts share a shard, unless their group is larger than half a shard in any of
    bytes, tokens and rows: it is then dealt row by row over pieces of about an eighth. Null ids, repeated ids and repeated
    rows are placed like all others. An empty table has no rows.
    """
    base = cut(_measured(docs, id_col, text_col, carry, tokens))
    totals = base.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    capacity = np.array([max(t or 0, 1) / shards for t in totals])
    groups = base.groupBy("group").agg(F.max("size").alias("size"), F.max("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    demand = [F.col("size") * F.col("n"), F.col("tokens") * F.col("n"), F.col("n")]
    shares = [(d / F.lit(float(c))).alias(name) for d, c, name in zip(demand, capacity, DIMENSIONS)]
    groups = cut(groups.select("group", *shares).withColumn("most", F.greatest(*DIMENSIONS)))
    light = groups.where(F.col("most") < HEAVY)
    heavy = base.join(F.broadcast(_pieces(groups)), "group").withColumn("piece", F.pmod(F.xxhash64("at"), "pieces"))
    room, homes = _place_heavy(heavy, capacity, shards)
    sums = light.agg(*[F.sum(d) for d in DIMENSIONS], F.count(F.lit(1))).first()
    cells = light.withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(max(1, -(-sums[3] // CELL)))))
    filled = [float(s or 0) for s in sums[:3]]
    small = cells.groupBy("cell").applyInArrow(lambda cell: _fill(room, filled, cell), "group binary, shard int")
    kept = [c for c in base.columns if c != "group"]
    placed = base.join(small, "group").select(*kept, "shard")
    if homes:
        known = base.sparkSession.createDataFrame(homes, "group binary, piece long, shard int")
        placed = placed.unionByName(heavy.join(F.broadcast(known), ["group", "piece"]).select(*kept, "shard"))
    return _numbered(cut(placed.withColumn("part", F.spark_partition_id())))


def _measured(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str], tokens: Column | None) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_count(text, F.lit(WORD)) if tokens is None else F.coalesce(tokens, F.lit(0))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("struct<>")).alias("row"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        words.cast("long").alias("tokens"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
        F.monotonically_increasing_id().alias("at"),
    )


def _pieces(groups: DataFrame) -> DataFrame:
    """The heavy groups, with the number of pieces each is split into: a bounded table."""
    pieces = F.when(F.col("most") > WHOLE, F.ceil(F.col("most") / PIECE)).otherwise(1)
    return groups.where(F.col("most") >= HEAVY).select("group", pieces.cast("long").alias("pieces"))


def _place_heavy(heavy: DataFrame, capacity: np.ndarray, shards: int) -> tuple[np.ndarray, list]:
    """The room left in every shard, and the shard of every heavy piece."""
    sums = heavy.groupBy("group", "piece").agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).collect()
    room = np.ones((shards, len(DIMENSIONS)))
    demand = np.array([r[2:] for r in sums], float).reshape(-1, len(DIMENSIONS)) / capacity
    chosen = _greedy(room, demand, [(bytes(r[0]), r[1]) for r in sums])
    return room, [(bytearray(r[0]), r[1], int(s)) for r, s in zip(sums, chosen)]


def _greedy(room: np.ndarray, demand: np.ndarray, names: list) -> np.ndarray:
    """The shard of every group; ``room`` is taken up. The largest come first, and names decide between equal ones."""
    chosen = np.empty(len(demand), np.int32)
    for i in sorted(range(len(demand)), key=lambda i: (-demand[i].max(), names[i])):
        shard = int(np.argmax(room @ demand[i]))
        room[shard] -= demand[i]
        chosen[i] = shard
    return chosen


def _fill(room: np.ndarray, totals: list[float], cell: pa.Table) -> pa.Table:
    """Places a cell's groups into its part of the room."""
    demand = np.column_stack([cell.column(d).to_numpy() for d in DIMENSIONS])
    names = cell.column("group").to_pylist()
    part = np.array([d / t if t else 0.0 for d, t in zip(demand.sum(axis=0), totals)])
    chosen = _greedy(room * part, demand, names)
    return pa.table([pa.array(names, pa.binary()), pa.array(chosen, pa.int32())], ["group", "shard"])


def _numbered(placed: DataFrame) -> DataFrame:
    """Slots: the rows of a shard in earlier partitions, and those before in the same one. No task sees a whole shard."""
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    here = F.row_number().over(Window.partitionBy("part", "shard").orderBy("at")) - 1
    return placed.withColumn("here", here).join(starts, ["part", "shard"]).select(
        "id", "row", "size", "tokens", "text_crc32", "shard", (F.col("start") + F.col("here")).alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of ``docs`` as Parquet, one folder per shard, in slot order; a large shard has several files."""
    placed = place(docs, shards, id_col, text_col, docs.columns)
    name = fresh(docs, "shard")
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("row.*", F.col("shard").alias(name)).write.partitionBy(name).parquet(folder)
