"""Exact substring dedup over windows of words, by super-k-mers.

The minimiser of a window is the run of ``K`` words in it with the smallest hash. Neighbouring windows that share one travel
together, as one packed string of words, to the bucket of their minimiser; equal windows have equal minimisers, so all
occurrences of a window meet there and are sorted. Windows are compared by hash first and then word by word.

A bucket that gets too much text, since a run of words is common among different ones, is dealt anew, window by window, by the
hash of the whole window.

A task packs some megabytes of text at a time. Of equal strings in it only those of the smallest document travel on: in the
others every window is already known to be a repeat. So however often a passage occurs, its bucket gets it once a pack.
"""

from __future__ import annotations

import math
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, fresh, input_bytes

#: Words of a minimiser.
K = 3
#: Bytes of text packed at a time, and of packed strings that a bucket should get.
PACK, BUCKET = 8 << 20, 12 << 20
#: Bytes of strings from which a bucket is dealt anew.
SPLIT = 24 << 20
#: Compression of packs and of texts on their way through a shuffle.
LEVEL, TEXT_LEVEL = 9, 3
# Odd multipliers that mix hashes.
MIX_A, MIX_B, MIX_C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
SPANS = "id long, text_hash long, start int, stop int"
MET = pa.schema(
    [("id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("bucket", pa.int32()), ("pack", pa.binary())]
)


def repeated_spans(
    docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT
) -> DataFrame:
    """Stretches of words that repeat, as (id, text_hash, start, stop), counting words from 0.

    A word is a run without ASCII white space, unchanged. A window is ``window`` words in a row of one text; it is a repeat
    where a document with a smaller id holds the same words. Stretches may overlap. Null texts have no words. Rows with a
    null id neither repeat nor are repeated. Rows that share an id are no repeats of each other. A bucket of over ``split``
    bytes of strings is dealt anew by whole windows.
    """
    size, _ = input_bytes(docs, text_col)
    k = min(K, window)
    buckets = max(64, math.ceil(size * (1 + 2 * window / (window - k + 2)) / BUCKET))
    source = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )
    packed = source.mapInArrow(partial(_pack_batches, window, k, buckets), "bucket int, known boolean, pack binary")
    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
    met = cut(ordered.mapInArrow(partial(_meet, window, split, buckets), f"{SPANS}, bucket int, pack binary"))
    anew = met.where("pack IS NOT NULL").select("bucket", F.lit(False).alias("known"), "pack")
    anew = anew.groupBy("bucket").applyInArrow(lambda packs: _count_bucket(window, packs), SPANS)
    return met.where("pack IS NULL").select("id", "text_hash", "start", "stop").unionByName(anew)


def remove_repeats(
    docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", split: int = SPLIT
) -> DataFrame:
    """``docs`` with a struct column ``dedup`` (n_words int, n_removed int, kept string) for every row.

    Every word inside a repeated window is removed, as judged on the input. ``kept`` joins the other words by one space.
    The name of the column is lengthened by underscores if ``docs`` has it.
    """
    spans = repeated_spans(docs, window, id_col, text_col, split)
    spans = spans.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    names = {c: fresh(docs, c) for c in spans.columns}
    spans = spans.select(*[F.col(c).alias(n) for c, n in names.items()])
    mark = fresh(docs, "mark")
    docs = docs.withColumn(mark, F.xxhash64(text_col))

    @F.arrow_udf("binary")
    def pressed(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=TEXT_LEVEL).compress
        return pa.array([press(t.encode()) if t is not None else None for t in texts.to_pylist()], pa.binary())

    @F.arrow_udf("n_words int, n_removed int, kept string")
    def kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_kept(texts.to_pylist(), spans.to_pylist()), ["n_words", "n_removed", "kept"])

    # a text meets its spans in compressed form, which halves what this shuffle moves
    small = fresh(docs, "pressed")
    docs = docs.withColumn(small, pressed(F.col(text_col)))
    same = (docs[id_col].cast("long") == spans[names["id"]]) & (docs[mark] == spans[names["text_hash"]])
    cut_out = kept(F.col(small), F.col(names["spans"]))
    return docs.join(spans, same, "left").withColumn(fresh(docs, "dedup"), cut_out).drop(small, mark, *names.values())


def _kept(texts, all_spans):
    counts, removed, left = [], [], []
    unpress = zstandard.ZstdDecompressor().decompress
    for text, spans in zip(texts, all_spans):
        words = unpress(text).split() if text else []
        counts.append(len(words))
        if spans:
            stay, at = [], 0
            for span in spans:
                stay += words[at : span["start"]]
                at = max(at, span["stop"])
            words = stay + words[at:]
        removed.append(counts[-1] - len(words))
        left.append(b" ".join(words))
    return [pa.array(counts, pa.int32()), pa.array(removed, pa.int32()), pa.array(left, pa.binary()).cast(pa.string())]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(29))) * MIX_B
    return hashes ^ (hashes >> np.uint64(32))


def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` values in a row."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for i in range(n):
        out = out * MIX_A + hashes[i : i + len(out)]
    return _mixed(out)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return _mixed(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + MIX_C)


def _lowest(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every ``n`` values in a row, by doubling."""
    reach = 1
    while reach < n:
        step = min(reach, n - reach)
        values = np.minimum(values[: len(values) - step], values[step:])
        reach += step
    return values


def _pack_batches(window, k, buckets, batches):
    held, size = [], 0
    press = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        columns = (batch.column(c) for c in ("id", "text_hash", "text"))
        for doc, mark, text in zip(*(c.to_pylist() for c in columns)):
            words = text.encode().split()
            if len(words) >= window:
                held.append((doc, mark, b" ".join(words), _word_hashes(words)))
                size += len(held[-1][2])
            if size >= PACK:
                yield from _packed(held, window, k, buckets, press)
                held, size = [], 0
    if held:
        yield from _packed(held, window, k, buckets, press)


def _packed(held, window, k, buckets, press):
    """The packs of some texts: a row for each bucket, and one with the repeats found among these texts."""
    text = b"\n".join(h[2] for h in held)
    hashes = np.concatenate([h[3] for h in held])
    counts = np.array([len(h[3]) for h in held])
    first_word = np.concatenate(([0], np.cumsum(counts)))
    starts, ends, _ = _places(text)
    doc = np.repeat(np.arange(len(held)), counts)
    runs = _rolled(hashes, k)
    # the hash orders the runs; on a tie the first run of the window wins, as its place is in the lower half
    keys = (runs & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(runs), dtype=np.uint64)
    lowest = _lowest(keys, window - k + 1)
    at = np.flatnonzero(doc[: len(lowest)] == doc[window - 1 : window - 1 + len(lowest)])
    chosen = (lowest[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    first, last = at[new], at[np.concatenate((new[1:], [len(at)])) - 1] + window
    bucket = ((runs[chosen[new]] * MIX_C) >> np.uint64(33)) % np.uint64(buckets)
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    same = np.array(
        [number(text[a:b], len(numbers)) for a, b in zip(starts[first].tolist(), ends[last - 1].tolist())], np.int64
    )
    ids = np.array([h[0] for h in held], np.int64)
    marks = np.array([h[1] for h in held], np.int64)
    owner = doc[first]
    least = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(least, same, ids[owner])
    known = ids[owner] > least[same]
    begin, end = first - first_word[owner], last - first_word[owner]
    if known.any():
        spans = _merged(owner[known], begin[known], end[known])
        blob = _frame(ids[spans[0]], marks[spans[0]], *spans[1:], press=press)
        yield _row(int(ids[spans[0][0]] % buckets), True, blob)
    strings = list(numbers)
    live = np.flatnonzero(~known)
    live = live[np.argsort(bucket[live], kind="stable")]
    cuts = np.flatnonzero(np.diff(bucket[live].astype(np.int64))) + 1
    for part in np.split(live, cuts):
        if len(part):
            names, place = np.unique(same[part], return_inverse=True)
            body = b"\n".join(map(strings.__getitem__, names.tolist()))
            o = owner[part]
            yield _row(int(bucket[part[0]]), False, _frame(ids[o], marks[o], begin[part], place, press=press, body=body))


def _row(bucket, known, blob):
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([known]), pa.array([blob], pa.binary())], ["bucket", "known", "pack"]
    )


def _frame(ids, marks, a, b, press, body=b"") -> bytes:
    """Two columns of longs, two of ints, and strings, compressed."""
    head = np.int64(len(ids)).tobytes() + ids.astype(np.int64).tobytes() + marks.astype(np.int64).tobytes()
    return press.compress(head + a.astype(np.int32).tobytes() + b.astype(np.int32).tobytes() + body)


def _unframed(blob: bytes, press):
    data = press.decompress(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ids, marks = np.frombuffer(data, np.int64, 2 * n, 8).reshape(2, n)
    a, b = np.frombuffer(data, np.int32, 2 * n, 8 + 16 * n).reshape(2, n)
    return ids, marks, a, b, data[8 + 24 * n :]


def _places(text: bytes):
    """Where words start and end, and where in these a new string starts."""
    octets = np.frombuffer(text, np.uint8)
    gaps = np.flatnonzero((octets == 32) | (octets == 10))
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(text)]))
    return starts, ends, np.concatenate(([0], np.flatnonzero(octets[gaps] == 10) + 1))


def _merged(owner, begin, end):
    """Overlapping or touching stretches of one owner, made one."""
    if not len(owner):
        return owner, begin, end
    order = np.lexsort((begin, owner))
    owner, begin, end = owner[order], begin[order], end[order]
    # stretches of an owner start in order and none ends before the one ahead of it
    far = np.maximum.accumulate(end + owner * (1 << 40))
    new = np.concatenate(([True], begin[1:] + owner[1:] * (1 << 40) > far[:-1]))
    at = np.flatnonzero(new)
    stop = far[np.concatenate((at[1:], [len(owner)])) - 1]
    return owner[at], begin[at], stop - owner[at] * (1 << 40)


def _meet(window, split, parts, batches):
    """Repeats among the strings of every bucket, one after the other, and the windows of those with too much text as packs of
    their own, to be dealt anew."""
    unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=LEVEL)
    current, held, size = None, [], 0
    for batch in batches:
        for bucket, known, blob in zip(*(batch.column(c) for c in ("bucket", "known", "pack"))):
            if bucket.as_py() != current:
                if held and size <= split:
                    yield _spans(*_among(held, window))
                current, held, size = bucket.as_py(), [], 0
            frame = _unframed(blob.as_py(), unpress)
            if known.as_py():
                yield _spans(*frame[:4])
                continue
            held.append(frame)
            size += len(frame[4])
            if size > split:
                for part in held:
                    yield from _dealt_anew(part, window, parts, press)
                held = []
    if held and size <= split:
        yield _spans(*_among(held, window))


def _spans(ids, marks, starts, stops) -> pa.RecordBatch:
    n = len(ids)
    columns = [pa.array(ids), pa.array(marks), pa.array(starts.astype(np.int32)), pa.array(stops.astype(np.int32))]
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=MET)


def _dealt_anew(frame, window, parts, press):
    """The windows of a pack as strings, a pack for each bucket that the hash of the whole window gives."""
    ids, marks, begin, string, text = frame
    starts, ends, first = _places(text)
    of_word = np.repeat(np.arange(len(first)), np.diff(np.concatenate((first, [len(starts)]))))
    hashes = _rolled(_word_hashes(text.split()), window)
    at = np.flatnonzero(of_word[: len(hashes)] == of_word[window - 1 : window - 1 + len(hashes)])
    bucket = ((hashes[at] * MIX_C) >> np.uint64(33)) % np.uint64(parts)
    claims: dict[int, list[int]] = {}
    for i, s in enumerate(string.tolist()):
        claims.setdefault(s, []).append(i)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order].astype(np.int64))) + 1
    for part in np.split(order, cuts) if len(order) else ():
        numbers: dict[tuple[int, bytes], int] = {}
        rows = []
        for word in at[part].tolist():
            s = int(of_word[word])
            own = claims[s]  # all of one id, which keeps equal windows of other ids apart
            place = numbers.setdefault((int(ids[own[0]]), text[starts[word] : ends[word + window - 1]]), len(numbers))
            rows += [(i, word - int(first[s]), place) for i in own]
        picked, shift, place = (np.array(c, np.int64) for c in zip(*rows))
        body = b"\n".join(name for _, name in numbers)
        blob = _frame(ids[picked], marks[picked], begin[picked] + shift, place, press=press, body=body)
        row = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
        yield pa.RecordBatch.from_arrays([*row, pa.array([int(bucket[part[0]])], pa.int32()), pa.array([blob], pa.binary())], schema=MET)


def _count_bucket(window, table: pa.Table) -> pa.Table:
    """Repeats among the strings of a bucket, and those that the packs have found."""
    press, found, held = zstandard.ZstdDecompressor(), [], []
    for known, blob in zip(table.column("known").to_pylist(), table.column("pack")):
        frame = _unframed(blob.as_py(), press)
        if known:
            found.append(frame[:4])
        else:
            held.append(frame)
    if held:
        found.append(_among(held, window))
    ids, marks, a, b = (np.concatenate(c) for c in zip(*found))
    columns = [pa.array(c) for c in (ids, marks, a.astype(np.int32), b.astype(np.int32))]
    return pa.table(columns, ["id", "text_hash", "start", "stop"])


def _among(frames, window):
    """Repeats among the strings of some packs."""
    bodies, claims, strings = [], [], 0
    for ids, marks, a, b, body in frames:
        bodies.append(body)
        claims.append((ids, marks, a, b + strings))
        strings += body.count(b"\n") + 1
    return _repeats(b"\n".join(bodies), [np.concatenate(c) for c in zip(*claims)], strings, window)


def _repeats(text, claims, strings, window):
    ids, marks, begin, string = claims
    owner = np.zeros(strings, np.int64)
    owner[string] = ids  # all claims on a string have one id
    starts, ends, first = _places(text)
    counts = np.diff(np.concatenate((first, [len(starts)])))
    of_word = np.repeat(np.arange(strings), counts)
    hashes = _rolled(_word_hashes(text.split()), window)
    at = np.flatnonzero(of_word[: len(hashes)] == of_word[window - 1 : window - 1 + len(hashes)])
    order = at[np.lexsort((owner[of_word[at]], hashes[at]))]
    hashes, holder = hashes[order], owner[of_word[order]]
    group = np.cumsum(np.concatenate(([0], hashes[1:] != hashes[:-1])))
    head = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    repeat = holder > holder[head[group]]
    # equal hashes are not proof: the words decide
    low, high = starts[order], ends[order + window - 1]
    lead = head[group[repeat]]
    pairs = zip(low[repeat].tolist(), high[repeat].tolist(), low[lead].tolist(), high[lead].tolist())
    equal = np.array([text[a:b] == text[c:d] for a, b, c, d in pairs], bool)
    for g in set(group[repeat][~equal].tolist()):
        members = np.flatnonzero(group == g)
        least: dict[bytes, int] = {}
        for m in members.tolist():
            least.setdefault(text[low[m] : high[m]], int(holder[m]))
        for m in members.tolist():
            repeat[m] = holder[m] > least[text[low[m] : high[m]]]
    words = np.sort(order[repeat])
    owners, begins, stops = _merged(of_word[words], words - first[of_word[words]], words - first[of_word[words]] + window)
    # a stretch of a string holds for every claim on it
    by_string = np.argsort(string, kind="stable")
    from_, to = np.searchsorted(string[by_string], owners), np.searchsorted(string[by_string], owners, "right")
    times = to - from_
    picked = by_string[np.repeat(from_, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    shift = begin[picked]
    return ids[picked], marks[picked], np.repeat(begins, times) + shift, np.repeat(stops, times) + shift
