"""Line dedup over overlapping windows of three lines.

Every three consecutive lines are hashed; a window that occurs more than once in all documents is a repeat. Its first
occurrence stays, and in all later ones its lines go. First means the smallest id, then the earliest line.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import few, fresh


def lines(text: Column) -> Column:
    """The lines of a text, parted by line feeds; none for null."""
    return F.split(text, "\n")


def later_windows(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Windows of ``size`` lines that have occurred before, as (id, text_hash, starts: sorted places of their first lines).

    Windows without a character other than white space do not count. Rows without an id come after all others. Rows that
    share id and text are judged alike, so none of them is later than another. Texts of fewer lines have no window.
    """
    split = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), lines(F.col(text_col)).alias("lines"))
    joined = F.transform("lines", lambda x, i: F.concat_ws("\n", *[F.get("lines", i + j) for j in range(size)]))
    whole = F.slice(joined, 1, F.greatest(F.lit(0), F.size("lines") - (size - 1)))
    windows = split.where(F.size("lines") >= size).select("id", "text_hash", F.posexplode(whole).alias("start", "window"))
    windows = windows.where(F.col("window").rlike(r"\S")).select(
        F.struct(F.col("id").isNull().alias("nameless"), "id", "text_hash", "start").alias("place"),
        F.unhex(F.md5("window")).alias("mark"),
    )
    first = windows.groupBy("mark").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first <> last")
    later = windows.join(first.select("mark", "first"), "mark").where("place > first")
    return later.groupBy("place.id", "place.text_hash").agg(F.array_sort(F.collect_set("place.start")).alias("starts"))


def remove_repeats(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``dedup`` (n_lines int, n_removed int, kept string) for every row.

    A line goes if a later window covers it, so overlapping windows are merged. ``kept`` joins the other lines by line feeds
    and is null for a null text, which has no lines; an empty text is one empty line. The name of the column is lengthened
    by underscores if ``docs`` has it.
    """
    windows = later_windows(docs, size, id_col, text_col)
    names = {c: fresh(docs, c) for c in windows.columns}
    windows = windows.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = docs[id_col].eqNullSafe(windows[names["id"]]) & (F.xxhash64(docs[text_col]) == windows[names["text_hash"]])

    @F.arrow_udf("n_lines int, n_removed int, kept string")
    def kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return _kept(size, batches)

    cut_out = kept(F.col(text_col), F.col(names["starts"]))
    return docs.join(windows, same, "left").withColumn(fresh(docs, "dedup"), cut_out).drop(*names.values())


def _kept(size, batches):
    """What stays of every text without its later windows, which are given by the places of their first lines."""
    for batch in batches:
        for texts, starts in zip(*map(few, batch)):
            counts, removed, left = [], [], []
            for text, places in zip(texts.to_pylist(), starts.to_pylist()):
                all_lines = text.split("\n") if text is not None else []
                stay, at = [], 0
                for place in places or ():
                    stay += all_lines[at:place]
                    at = max(at, place + size)
                stay += all_lines[at:]
                counts.append(len(all_lines))
                removed.append(len(all_lines) - len(stay))
                left.append(None if text is None else "\n".join(stay))
            columns = [pa.array(counts, pa.int32()), pa.array(removed, pa.int32()), pa.array(left, pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_lines", "n_removed", "kept"])
