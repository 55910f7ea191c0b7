"""Bronze to Silver, event by event as they arrive."""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from convoy.operators.silver import GPS_RULES, TopicRules, accepted, check_events, dedup_positions, rejected
from convoy.sources import files, manifest
from convoy.sources.bronze import ENVELOPE

KEYS = ["vehicle_id", "timestamp"]
#: The part of the table that holds rejected events; good ones lie by event day.
REJECTED = "rejected"
#: Name of the figures a micro-batch reports.
OUTCOMES = "outcomes"
#: Seconds an event may lag behind the newest one without being late.
DELAY = 600
#: Folders of a day and level that are merged into one of the next level.
COMPACT_AT = 16


def write_silver(
    envelopes: DataFrame,
    rules: TopicRules,
    path: str,
    checkpoint: str,
    delay: int = DELAY,
    compact_at: int = COMPACT_AT,
    retain: int = manifest.RETAIN,
    **trigger,
) -> StreamingQuery:
    """Check events and keep the good and the bad ones in ``path``, however late they come.

    Of one vehicle and instant only an event with a lower offset than any stored one is added, and ``read_stream_silver``
    shows the lowest. An event within ``delay`` seconds of the newest one seen before is compared with what is stored from
    there on; only for later ones whole event days are read. Every micro-batch is one commit of the table's log; one that was
    committed before a restart is passed over. Folders of a day are merged ``compact_at`` at a time, level by level, so
    that their number grows with the logarithm of the batches; see ``manifest`` for when the old ones go.
    """

    def store(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        number, state = manifest.newest(spark, path)
        if batch <= state.get("last", -1):
            return
        number, state = _add(events, batch, rules, path, delay, number, state, retain)
        due = _due(state["entries"], compact_at)
        if due:
            _compact(spark, rules, path, due, number, state, retain)
            manifest.sweep(spark, path)

    checked = check_events(envelopes, rules)
    good = F.col("reject_reason").isNull()
    checked = checked.observe(OUTCOMES, F.count_if(good).alias("processed"), F.count_if(~good).alias("rejected"))
    writer = checked.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _part() -> Column:
    """Where a checked event lies: with the events of its day, or with the rejected ones."""
    return F.when(F.col("reject_reason").isNull(), F.date_format("timestamp", "yyyy-MM-dd")).otherwise(REJECTED)


def _add(events, batch, rules, path, delay, number, state, retain) -> tuple[int, dict]:
    """Store a micro-batch: parsed once, counted, compared with stored events, written once, committed."""
    spark, entries = events.sparkSession, state.get("entries", [])
    held = events.withColumn("part", _part()).persist()
    try:
        at = F.unix_micros("timestamp")
        found = held.groupBy("part", "reject_reason").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("low"), F.max(at).alias("high"))
        found = found.collect()
        days = {row["part"]: row for row in found if row["part"] != REJECTED}
        rows, edge = held, state.get("high")
        if rules.topic == GPS_RULES.topic:
            edge = None if edge is None else edge - delay * 1_000_000
            late = [day for day, row in days.items() if edge is not None and row["low"] <= edge]
            rows = _without_stored(spark, rules, path, held, edge, late, entries)
        folder = f"data=b{batch}-{uuid.uuid4().hex[:12]}"
        rows.hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/{folder}")
    finally:
        held.unpersist()
    written = [name.removeprefix("part=") for name in files.names(spark, f"{path}/{folder}") if name.startswith("part=")]
    for part in written:
        low, high = (days[part]["low"], days[part]["high"]) if part in days else (None, None)
        entries = [*entries, {"folder": f"{folder}/part={part}", "part": part, "low": low, "high": high, "level": 0}]
    counts = Counter(state.get("counts", {}))
    for row in found:
        counts[row["reject_reason"] or ""] += row["n"]
    newest = [x for x in (state.get("high"), *(row["high"] for row in days.values())) if x is not None]
    state = {**state, "last": batch, "high": max(newest, default=None), "counts": dict(counts), **_live(entries)}
    number = manifest.commit(spark, path, number, state, retain=retain)
    return manifest.newest(spark, path)


def _live(entries: list[dict]) -> dict:
    return {"entries": entries, "folders": [entry["folder"] for entry in entries]}


def to_compare(entries: list[dict], edge: int | None, late: list[str]) -> list[dict]:
    """The entries that may hold copies: those with events after ``edge``, and those of the days that late events fall on."""
    good = [entry for entry in entries if entry["part"] != REJECTED]
    return [entry for entry in good if edge is None or entry["high"] > edge or entry["part"] in late]


def _without_stored(spark, rules, path, held, edge, late, entries) -> DataFrame:
    """The rejected events, and of good ones the lowest of each vehicle and instant unless a lower or equal one is stored."""
    good = dedup_positions(held.where("reject_reason IS NULL"))
    compared = to_compare(entries, edge, late)
    if compared:
        stored = _read(spark, rules, path, compared).withColumn("part", _part())
        if edge is not None:
            stored = stored.where((F.unix_micros("timestamp") > edge) | F.col("part").isin(late))
        lowest = stored.groupBy(*KEYS).agg(F.min(F.struct("_offset", "_partition")).alias("_lowest"))
        newer = F.col("_lowest").isNull() | (F.struct("_offset", "_partition") < F.col("_lowest"))
        # the keys fix the part, and by them alone the events are dealt already
        good = good.join(lowest, KEYS, "left").where(newer).drop("_lowest")
    return good.unionByName(held.where("reject_reason IS NOT NULL"))


def _due(entries: list[dict], compact_at: int) -> list[dict]:
    """The entries to merge: of each part those of the lowest level that has enough of them."""
    levels = defaultdict(list)
    for entry in entries:
        levels[entry["part"], entry["level"]].append(entry)
    due: dict[str, list[dict]] = {}
    for (part, _), same in sorted(levels.items()):
        if len(same) >= compact_at and part not in due:
            due[part] = same
    return [entry for same in due.values() for entry in same]


def _compact(spark, rules, path, due, number, state, retain) -> None:
    """Merge entries part by part in one job and swap them by one commit. Until it, readers see the old ones."""
    rows = _read(spark, rules, path, due)
    if rules.topic == GPS_RULES.topic:
        rows = dedup_positions(rows.where("reject_reason IS NULL")).unionByName(rows.where("reject_reason IS NOT NULL"))
    folder = f"data=c{number}-{uuid.uuid4().hex[:12]}"
    ordered = rows.withColumn("part", _part()).hint("rebalance", "part").sortWithinPartitions("part", "timestamp")
    ordered.write.partitionBy("part").parquet(f"{path}/{folder}")
    merged = defaultdict(list)
    for entry in due:
        merged[entry["part"]].append(entry)
    gone = {entry["folder"] for entry in due}
    entries = [entry for entry in state["entries"] if entry["folder"] not in gone]
    for part, same in merged.items():
        times = [entry[side] for entry in same for side in ("low", "high") if entry[side] is not None]
        low, high = (min(times), max(times)) if times else (None, None)
        level = same[0]["level"] + 1
        entries.append({"folder": f"{folder}/part={part}", "part": part, "low": low, "high": high, "level": level})
    manifest.commit(spark, path, number, {**state, **_live(entries)}, sorted(gone), retain)


def _read(spark: SparkSession, rules: TopicRules, path: str, entries: list[dict]) -> DataFrame:
    """Checked events of some entries. Empty ones have no file to read columns from, so the schema is given."""
    schema = check_events(spark.createDataFrame([], ENVELOPE), rules).schema
    if not entries:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{entry['folder']}" for entry in entries])


def _entries(spark: SparkSession, path: str, bad: bool) -> list[dict]:
    _, state = manifest.newest(spark, path)
    return [entry for entry in state.get("entries", []) if (entry["part"] == REJECTED) == bad]


def read_stream_silver(spark: SparkSession, path: str, rules: TopicRules) -> DataFrame:
    """What the stream has stored: every good event, and of positions one for each vehicle and instant."""
    stored = accepted(_read(spark, rules, path, _entries(spark, path, bad=False)))
    return dedup_positions(stored) if rules.topic == GPS_RULES.topic else stored


def read_stream_quarantine(spark: SparkSession, path: str, rules: TopicRules) -> DataFrame:
    """The rejected events, with their reasons."""
    return rejected(_read(spark, rules, path, _entries(spark, path, bad=True)))


def read_stream_counts(spark: SparkSession, path: str, rules: TopicRules) -> DataFrame:
    """Events so far as (topic, reject_reason, events), the reason being NULL for good ones. They come with the rows' commit."""
    _, state = manifest.newest(spark, path)
    rows = [(rules.topic, reason or None, n) for reason, n in state.get("counts", {}).items()]
    return spark.createDataFrame(rows, "topic string, reject_reason string, events long")


class BatchCounts(StreamingQueryListener):
    """Hands on the processed and rejected events of every micro-batch as it ends.

    ``report`` gets the query's name or id, the batch, and both numbers. Spark tells a listener once at most, so these are for
    watching a stream; ``read_stream_counts`` is exact.
    """

    def __init__(self, report: Callable[[str, int, int, int], None]):
        self.report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = progress.observedMetrics.get(OUTCOMES)
        if figures is not None:
            self.report(progress.name or str(progress.id), progress.batchId, figures["processed"], figures["rejected"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_quarantine(envelopes: DataFrame, rules: TopicRules) -> DataFrame:
    return rejected(check_events(envelopes, rules))


def append_parquet(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
