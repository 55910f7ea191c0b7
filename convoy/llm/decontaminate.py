"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every run of ``K`` words is hashed. Of the hashes inside a window of ``span`` words only the smallest counts: a window of a
document can equal a window of a benchmark item only if both have the same smallest hash. Documents meet the benchmark on
these fingerprints; hits are then extended to whole windows, compared word by word, and merged into covered stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut

# Fixed value: ASCII characters that part words; all others, and all beyond ASCII, belong to words.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a hashed run, at most.
K = 6
#: Benchmark windows up to which the benchmark is sent to every executor: at a hundred bytes each some 20 MB.
SMALL = 200_000


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    plain = F.octet_length(text) == F.char_length(text)  # in ASCII, lower() touches A-Z only and is faster
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.split(F.coalesce(lowered, F.lit("")), GAPS)


def _trimmed(column: str) -> Column:
    """A split text starts or ends with an empty word where it starts or ends with a gap."""
    c = F.col(column)
    first = F.when(F.element_at(c, 1) == "", 2).otherwise(1)
    drop = F.when(F.element_at(c, -1) == "", 1).otherwise(0)
    return F.slice(c, first, F.greatest(F.lit(0), F.size(c) - drop - first + 1))


def _runs(hashes: str, k: int) -> Column:
    """A hash for every run of ``k`` words."""
    h = F.col(hashes)
    if k == 1:
        return h
    runs = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))
    return F.slice(runs, 1, F.greatest(F.lit(0), F.size(h) - (k - 1)))


def _fingerprints(runs: str, window: int) -> Column:
    """The smallest of every ``window`` hashes in a row."""
    r = F.col(runs)
    if window == 1:
        return r
    least = F.transform(r, lambda x, i: F.least(x, *[F.get(r, i + j) for j in range(1, window)]))
    return F.slice(least, 1, F.greatest(F.lit(0), F.size(r) - (window - 1)))


def _worded(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("split_text", words(F.col(text))).withColumn("words", _trimmed("split_text")).drop("split_text", text)


def _marked(df: DataFrame, span: int, shorter: list[int]) -> DataFrame:
    """``df``, whose words are known, with the fingerprints of windows of ``span`` words and of each length in ``shorter``."""
    k, names = min(K, span), df.columns
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("runs", _runs("hashes", k)).withColumn("of_span", _fingerprints("runs", span - k + 1))
    for n in shorter:
        df = df.withColumn(f"of_{n}", _runs("hashes", n))
    return df.select(*names, "of_span", *[f"of_{n}" for n in shorter])


def _all(shorter: list[int]) -> Column:
    return F.concat("of_span", *[f"of_{n}" for n in shorter])


def _placed(span: int, shorter: list[int]) -> list[Column]:
    """Where the window at place ``pos`` (from 1) of all fingerprints starts, and how long it is."""
    start, length, offset = F.col("pos"), F.lit(span), F.greatest(F.lit(0), F.col("n_words") - (span - 1))
    for n in shorter:
        later = F.col("pos") > offset
        start, length = F.when(later, F.col("pos") - offset).otherwise(start), F.when(later, n).otherwise(length)
        offset = offset + F.greatest(F.lit(0), F.col("n_words") - (n - 1))
    return [start.alias("start"), length.alias("length")]


def _windows(items: DataFrame, span: int, shorter: list[int]) -> DataFrame:
    """Every window of the benchmark, as (gram, print, item)."""
    marked = cut(_marked(items, span, shorter))
    long = marked.select("item", "words", F.posexplode("of_span").alias("pos", "print"))
    out = long.select(F.concat_ws(" ", F.slice("words", F.col("pos") + 1, span)).alias("gram"), "print", "item")
    for n in shorter:
        whole = marked.where(F.size("words") == n)
        out = out.unionByName(
            whole.select(F.concat_ws(" ", "words").alias("gram"), F.get(f"of_{n}", F.lit(0)).alias("print"), "item")
        )
    return out.distinct()


KEPT = ["id", "text_hash", "n_words"]


def _hits_in_place(source, prints, texts, span, shorter) -> DataFrame:
    """Occurrences of windows, as (id, text_hash, n_words, start, length, gram), and a row with start 0 for every document.

    One pass without a shuffle: both small tables are at hand wherever a document is.
    """
    marked = _marked(_worded(source, "doc_text"), span, shorter)
    none = F.array(F.lit(None).cast("long"))
    rows = marked.select(
        "id", "text_hash", "words", F.size("words").alias("n_words"), F.posexplode(F.concat(none, _all(shorter))).alias("pos", "print")
    )
    rows = rows.join(prints.withColumn("seen", F.lit(True)), "print", "left").where("seen OR pos = 0")
    rows = rows.select(*KEPT, "words", *_placed(span, shorter))
    gram = F.when(F.col("start") > 0, F.concat_ws(" ", F.slice("words", F.greatest(F.lit(1), "start"), F.col("length"))))
    rows = rows.select(*KEPT, "start", "length", gram.alias("gram"))
    rows = rows.join(texts.withColumn("equal", F.lit(True)), "gram", "left").where("equal OR start = 0")
    return rows.select(*KEPT, "start", "length", "gram")


def _hits_by_shuffle(source, prints, texts, span, shorter) -> DataFrame:
    """The same for a benchmark too large to send: fingerprints meet by shuffle, and only documents with hits go on."""
    keep = ["id", "text_hash"]
    marked = _marked(_worded(source, "doc_text"), span, shorter)
    every = marked.select(*keep, F.size("words").alias("n_words"))
    every = every.select(*KEPT, F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(None).cast("string").alias("gram"))
    met = marked.select(*keep, F.explode(F.array_distinct(_all(shorter))).alias("print")).join(prints, "print", "left_semi")
    met = met.groupBy(*keep).agg(F.collect_set("print").alias("prints"))
    met = met.select(F.col("id").alias("met_id"), F.col("text_hash").alias("met_hash"), "prints")
    same = F.col("id").eqNullSafe(F.col("met_id")) & (F.col("text_hash") == F.col("met_hash"))
    marked = _marked(_worded(source.join(met, same), "doc_text"), span, shorter)
    rows = marked.select(*keep, "words", "prints", F.size("words").alias("n_words"), F.posexplode(_all(shorter)).alias("at", "print"))
    rows = rows.where(F.array_contains("prints", F.col("print"))).withColumn("pos", F.col("at") + 1)
    rows = rows.select(*KEPT, "words", *_placed(span, shorter))
    rows = rows.select(*KEPT, "start", "length", F.concat_ws(" ", F.slice("words", "start", "length")).alias("gram"))
    return rows.join(texts, "gram").select(*KEPT, "start", "length", "gram").unionByName(every)


def _covered(spans: str) -> Column:
    """Words covered by (start, length) spans."""
    end = lambda s: s["start"] + s["length"]
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], end(s)).alias("end"),
            (a["n"] + F.greatest(F.lit(0), end(s) - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    small: int = SMALL,
) -> DataFrame:
    """How much of every document lies inside windows of benchmark items, a row for every row of ``docs``.

    A window is ``span`` words of an item in a row; an item of fewer words, but not none, is one window. Returns (id,
    text_hash, n_words, n_hit: words inside any occurrence of a window, items: sorted ids of the items with an occurring
    window, as text). Null and empty texts have no words. Rows with the same id and text hash get the same result. An
    item without an id is found but not listed; items that share an id are listed once. Empty tables give no hits.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("item_text"))
    items = cut(_worded(items, "item_text"))
    sizes = items.select(F.size("words").alias("n"))
    shorter = sorted(r["n"] for r in sizes.where((F.col("n") > 0) & (F.col("n") < span)).distinct().collect())
    windows = cut(_windows(items, span, shorter))
    texts = windows.select("gram").distinct()
    prints = windows.select("print").distinct()
    few = windows.count() <= small  # the documents play no part in what is sent
    keep = [F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash")]
    source = docs.select(*keep, F.col(text_col).alias("doc_text"))
    if few:
        hits = _hits_in_place(source, F.broadcast(prints), F.broadcast(texts), span, shorter)
    else:
        hits = _hits_by_shuffle(source, prints, texts, span, shorter)
    hits = cut(hits)
    key = [F.col("id"), F.col("text_hash")]
    spans = F.collect_set(F.when(F.col("start") > 0, F.struct("start", "length")))
    totals = hits.groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.count(F.when(F.col("start") == 0, 1)).alias("copies"), spans.alias("spans")
    )
    named = windows.where("item IS NOT NULL").select("gram", "item").distinct()
    named = F.broadcast(named) if few else named
    of_doc = hits.where("start > 0").select("id", "text_hash", "gram").distinct().join(named, "gram")
    of_doc = of_doc.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    of_doc = of_doc.select(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "items")
    same = F.col("id").eqNullSafe(F.col("hit_id")) & F.col("text_hash").eqNullSafe(F.col("hit_hash"))
    return totals.join(of_doc, same, "left").select(
        "id",
        "text_hash",
        "n_words",
        _covered("spans").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
