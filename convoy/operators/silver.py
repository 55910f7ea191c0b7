"""Bronze to Silver: type, validate, deduplicate. Batch and stream share these functions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.functions import events
from convoy.functions.temporal import iso_timestamp
from convoy.operators.latest import first_rows
from convoy.schemas import DELIVERY_TOPIC, GPS_TOPIC, SILVER_GPS, VEHICLE_TOPIC

TRACK = ("vehicle_id", "timestamp")
LINEAGE = ("_kafka_topic", "_partition", "_offset")

# Fixed values.
DELIVERY_STATUSES = ("delayed", "picked_up", "delivered", "cancelled", "in_transit")
ENGINE_STATUSES = ("ON", "OFF")


@dataclass(frozen=True)
class TopicRules:
    """What a topic's events must hold.

    ``fields`` names the required fields and how each is read: text, time or number. A value that cannot be read so is
    NULL. ``accepts`` gives further conditions on the typed columns, by the name of the field they concern.
    """

    topic: str
    fields: Mapping[str, str]
    accepts: Callable[[], Mapping[str, Column]] = field(default=dict)


def _gps_limits() -> dict[str, Column]:
    return {
        "latitude": F.col("latitude").between(-90, 90),
        "longitude": F.col("longitude").between(-180, 180),
        "speed": (F.col("speed") >= 0) & ~F.isnan("speed"),
    }


GPS_RULES = TopicRules(
    GPS_TOPIC,
    {"vehicle_id": "text", "timestamp": "time", "latitude": "number", "longitude": "number", "speed": "number"},
    _gps_limits,
)
DELIVERY_RULES = TopicRules(
    DELIVERY_TOPIC,
    {"order_id": "text", "vehicle_id": "text", "timestamp": "time", "status": "text", "location": "text"},
    lambda: {"status": F.col("status").isin(*DELIVERY_STATUSES)},
)
VEHICLE_RULES = TopicRules(
    VEHICLE_TOPIC,
    {"vehicle_id": "text", "timestamp": "time", "engine_status": "text", "fuel_level": "number"},
    lambda: {
        "engine_status": F.col("engine_status").isin(*ENGINE_STATUSES),
        "fuel_level": F.col("fuel_level").between(0, 100),
    },
)
RULES = {rules.topic: rules for rules in (GPS_RULES, DELIVERY_RULES, VEHICLE_RULES)}


def _typed(envelopes: DataFrame, rules: TopicRules) -> DataFrame:
    """Add each field as found, as text, and as its own type. A step per form reads every field of the event once."""
    found = envelopes.withColumns({f"_v_{name}": events.field(F.col("event"), name) for name in rules.fields})
    texts = found.withColumns({f"_t_{name}": events.as_text(F.col(f"_v_{name}")) for name in rules.fields})
    reads = {
        "text": lambda name: F.col(f"_t_{name}"),
        "time": lambda name: iso_timestamp(F.col(f"_t_{name}")),
        "number": lambda name: events.as_number(F.col(f"_v_{name}"), F.col(f"_t_{name}")),
    }
    return texts.withColumns({name: reads[kind](name) for name, kind in rules.fields.items()}).withColumns(
        {"_kafka_topic": F.col("kafka_topic"), "_partition": F.col("partition"), "_offset": F.col("offset")}
    )


def _reject_reason(rules: TopicRules) -> Column:
    no_event = F.when(F.try_parse_json("raw").isNull(), "malformed_json").otherwise("missing_event")
    present = reduce(lambda a, b: a & b, [F.col(f"_v_{name}").isNotNull() for name in rules.fields])
    reasons = [F.when(F.col("event").isNull(), no_event), F.when(~present, "missing_field")]
    limits = rules.accepts()
    for name in rules.fields:
        good = F.col(name).isNotNull()
        if name in limits:
            good = good & limits[name]
        reasons.append(F.when(~good, f"bad_{name}"))
    return F.coalesce(*reasons)


def check_events(envelopes: DataFrame, rules: TopicRules) -> DataFrame:
    """Envelopes with typed fields, lineage and the first reason to reject them, NULL for a good event.

    Nothing is dropped. The event itself stays beside the typed columns, so fields the rules do not know survive.

    The reason is exploded from an array of one. A filter on a plain column would be moved below the JSON parsing with
    the whole expression copied into it for every use of a field, and each row would be parsed dozens of times.
    """
    reason = F.explode(F.array(_reject_reason(rules)))
    return _typed(envelopes, rules).select(*rules.fields, *LINEAGE, "event", "raw", reason.alias("reject_reason"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def rejected(checked: DataFrame) -> DataFrame:
    """The quarantine: lineage, the event or its raw text, and the reason."""
    return checked.where(F.col("reject_reason").isNotNull()).select(*LINEAGE, "event", "raw", "reject_reason")


def topic_counts(checked: DataFrame) -> DataFrame:
    """Processed and rejected events per topic."""
    return checked.groupBy(F.col("_kafka_topic").alias("topic")).agg(
        F.count_if(F.col("reject_reason").isNull()).alias("processed"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )


def reject_counts(checked: DataFrame) -> DataFrame:
    """Rejected events per topic and reason."""
    return (
        checked.where(F.col("reject_reason").isNotNull())
        .groupBy(F.col("_kafka_topic").alias("topic"), "reject_reason")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def dedup_positions(positions: DataFrame) -> DataFrame:
    """One event per vehicle and instant: the one with the lowest offset."""
    return first_rows(positions, ["vehicle_id", "timestamp"], [F.col("_offset").asc(), F.col("_partition").asc()])


def silver_gps(envelopes: DataFrame) -> DataFrame:
    """Clean positions of a Bronze batch, with lineage and the event."""
    return dedup_positions(accepted(check_events(envelopes, GPS_RULES)))


def gps_record(silver: DataFrame) -> DataFrame:
    """The five columns of a clean position."""
    return silver.select(*[F.col(f.name).cast(f.dataType) for f in SILVER_GPS])


def in_track_order(positions: DataFrame) -> DataFrame:
    """Rows ordered by vehicle and time over all output files.

    The range covers both columns, so a vehicle with many positions spans several tasks.
    """
    return positions.repartitionByRange(*TRACK).sortWithinPartitions(*TRACK)


def clean_tracks(positions: DataFrame, parts: int | None = None) -> DataFrame:
    """One event per vehicle and instant, ordered over all output files, after a single shuffle.

    All events of one instant fall into one range, which is all that removing copies needs. Spark chooses the number of
    ranges by size unless ``parts`` is given.
    """
    ranges = positions.repartitionByRange(*([parts] if parts else []), *TRACK)
    return dedup_positions(ranges).sortWithinPartitions(*TRACK)


def file_ranges(stored: DataFrame) -> DataFrame:
    """The rows and the first and last vehicle and time of every file of a stored table."""
    key = F.struct(*TRACK)
    files = stored.select("*", F.col("_metadata.file_path").alias("_file"))
    return files.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last")
    )


def overlapping_files(ranges: DataFrame) -> DataFrame:
    """The files whose range begins before that of an earlier one has ended: none if the table is in order over its files.

    One row per file goes through the window.
    """
    earlier = Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("_ended", F.max("last").over(earlier)).where(F.col("first") <= F.col("_ended")).drop("_ended")
