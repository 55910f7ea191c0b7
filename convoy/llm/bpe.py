"""Byte-level BPE: encoding whole texts in overlapping chunks, and decoding.

A text of up to ``chunk`` characters is one chunk. A longer one is cut into chunks that overlap; tasks split them into
pre-tokens side by side, each guessing that one starts at the chunk's first character. Two neighbours agree from the first
pre-token boundary that both have in their overlap, since a match depends only on where it starts and what follows. The
text between two such places is a piece, and pieces are encoded side by side. From the first overlap without a common
boundary on, the rest of that text is one piece.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import AT_ONCE, cut, fresh  # noqa: F401
from convoy.llm.common import few as _few

#: Characters behind a match that can change it.
AHEAD = 8
#: Pre-tokens whose ids a worker remembers.
REMEMBERED = 100_000


def vocabulary(docs: DataFrame, path: str) -> Broadcast:
    """The rank file at ``path``, which only the driver reads, sent to the executors once."""
    with open(path, "rb") as lines:
        return docs.sparkSession.sparkContext.broadcast(lines.read())


def _ranks(content: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class _Ids(dict):
    """The ids of a pre-token as bytes of 32-bit integers, worked out when first seen."""

    def __init__(self, ranks: dict[bytes, int]):
        # every pre-token is merged by itself: this pattern takes all it is given
        self.merges = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, token: str) -> bytes:
        ids = array("i", self.merges.encode_ordinary(token)).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = ids
        return ids


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_col: str = "text",
    ids_col: str = "ids",
    chunk: int = 1 << 15,
    overlap: int = 1 << 10,
) -> DataFrame:
    """``docs`` with the token ids of every whole text as ``ids_col`` (array of int).

    Every match of ``pattern`` is merged by itself by the ranks at ``path``; there are no special tokens. A null or empty
    text has no ids. Repeated long texts are encoded once. An empty table stays empty.
    """
    ranks = vocabulary(docs, path)

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split, ids = regex.compile(pattern).findall, _Ids(_ranks(ranks.value))
        for texts in batches:
            for few in _few(texts):
                yield _lists([b"".join(map(ids.__getitem__, split(t))) if t else b"" for t in few.to_pylist()])

    is_long = F.coalesce(F.char_length(text_col) > chunk, F.lit(False))
    text = F.col(text_col)
    short = docs.where(~is_long).withColumn(ids_col, encoded.asNondeterministic()(text))
    key = fresh(docs, "text_key")
    long = docs.where(is_long).withColumn(key, F.unhex(F.sha2(text, 256)))
    found = _long(long.select(F.col(key).alias("text_key"), text.alias("text")), ranks, pattern, chunk, overlap)
    found = found.select(F.col("text_key").alias(key), F.col("ids").alias(ids_col))
    return short.unionByName(long.join(found, key).drop(key))


def _long(texts: DataFrame, ranks: Broadcast, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """The ids of long texts, as (text_key, ids)."""
    keys = ["text_key", "n"]
    schema = "text_key binary, n int, start int, last boolean, text string"
    pieces = texts.mapInArrow(partial(_chunks, chunk, overlap), schema)
    # the shuffle spreads the chunks of a text over tasks and leaves one copy of each
    chunks = pieces.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("start", "last", "text")])
    step = chunk - overlap
    seams = chunks.mapInArrow(partial(_boundaries, pattern, step, overlap), "text_key binary, n int, head array<int>, tail array<int>")
    left = seams.select("text_key", "n", "tail")
    right = seams.select("text_key", (F.col("n") - 1).alias("n"), "head")
    meet = cut(left.join(right, keys).select(*keys, F.array_min(F.array_intersect("tail", "head")).alias("at")))
    apart = meet.where("at IS NULL").groupBy("text_key").agg(F.min("n").alias("apart"))
    starts = meet.select("text_key", (F.col("n") + 1).alias("n"), F.col("at").alias("begin"))
    spans = (
        chunks.join(starts, keys, "left")
        .join(meet.withColumnRenamed("at", "stop"), keys, "left")
        .join(apart, "text_key", "left")
        .withColumn("piece", F.least("n", F.coalesce("apart", "n")))
        .groupBy("text_key", "piece")
        .agg(F.sort_array(F.collect_list(F.struct("n", "start", "begin", "stop", "text"))).alias("parts"))
    )
    ids = spans.mapInArrow(partial(_encode_pieces, ranks, pattern), "text_key binary, piece int, ids array<int>")
    ordered = F.sort_array(F.collect_list(F.struct("piece", "ids")))
    return ids.groupBy("text_key").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))


def _chunks(chunk, overlap, batches):
    step = chunk - overlap
    names = ["text_key", "n", "start", "last", "text"]
    for batch in batches:
        for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist()):
            count = max(1, -(-(len(text) - overlap) // step))
            for first in range(0, count, 64):
                ns = range(first, min(count, first + 64))
                parts = [text[n * step : n * step + chunk if n + 1 < count else None] for n in ns]
                columns = [[key] * len(ns), list(ns), [n * step for n in ns], [n + 1 == count for n in ns], parts]
                types = [pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _boundaries(pattern, step, overlap, batches):
    """Where pre-tokens start in the overlaps of a chunk, as places in the text; only those that later text can't move."""
    split = regex.compile(pattern)
    for batch in batches:
        heads, tails = [], []
        rows = zip(*(batch.column(c).to_pylist() for c in ("n", "start", "last", "text")))
        for n, start, last, text in rows:
            safe = len(text) + 1 if last else len(text) - AHEAD
            places = [m.end() for m in split.finditer(text) if m.end() <= safe]
            heads.append([start + p for p in places if p <= overlap] if n else [])
            tails.append([start + p for p in places if p > step] if not last else [])
        columns = [batch.column("text_key"), batch.column("n"), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["text_key", "n", "head", "tail"])


def _encode_pieces(ranks, pattern, batches):
    split, ids = regex.compile(pattern), _Ids(_ranks(ranks.value))
    for batch in batches:
        made = []
        for parts in batch.column("parts").to_pylist():
            origin, text = parts[0]["start"], ""
            for part in parts:
                text = text[: part["start"] - origin] + part["text"]
            begin, stop = (parts[0]["begin"] or 0) - origin, parts[-1]["stop"]
            stop = len(text) if stop is None else stop - origin
            tokens = (m.group() for m in split.finditer(text, max(0, begin)) if m.start() < stop)
            made.append(b"".join(map(ids.__getitem__, tokens)))
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("piece"), _lists(made)], ["text_key", "piece", "ids"])


def decode(docs: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of every list of ids as ``bytes_col``; none for null. An id outside the ranks is an error."""
    ranks = vocabulary(docs, path)

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = {rank: text for text, rank in _ranks(ranks.value).items()}.__getitem__
        for lists in batches:
            lists = lists.fill_null([]) if lists.null_count else lists
            for few in _few(lists):
                ids, ends = few.values.to_numpy(), few.offsets.to_pylist()
                # a row at a time: as Python numbers, the ids of a batch would take ten times their room
                yield pa.array([b"".join(map(token, ids[a:b].tolist())) for a, b in zip(ends[:-1], ends[1:])], pa.binary())

    return docs.withColumn(bytes_col, decoded(F.col(ids_col)))


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256)
