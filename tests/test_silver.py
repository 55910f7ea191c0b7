import json

import pytest
from pyspark.sql import functions as F

from convoy.operators import silver
from convoy.sources import bronze

GOOD = {"vehicle_id": "V1", "timestamp": "2026-09-30T01:02:03+00:00", "latitude": 12.5, "longitude": 77.5, "speed": 40}
ORDER = {"order_id": "O1", "vehicle_id": "V1", "timestamp": "2026-09-30T01:02:03Z", "status": "delivered", "location": "x"}
STATE = {"vehicle_id": "V1", "timestamp": "2026-09-30", "engine_status": "ON", "fuel_level": 50}


def line(event, offset=0, topic="gps-events"):
    return json.dumps({"kafka_topic": topic, "partition": 0, "offset": offset, "event": event})


def checked(spark, lines, rules=silver.GPS_RULES):
    return silver.check_events(bronze.envelope_from_lines(spark.createDataFrame([(x,) for x in lines], "value string")), rules)


def reason(spark, text, rules=silver.GPS_RULES):
    rows = checked(spark, [text], rules).collect()
    assert len(rows) == 1
    return rows[0].reject_reason


def without(event, name):
    return {k: v for k, v in event.items() if k != name}


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, None),
        ({"latitude": "12.5"}, None),
        ({"latitude": True}, None),
        ({"speed": "inf"}, None),
        ({"speed": 0}, None),
        ({"latitude": 90, "longitude": -180}, None),
        ({"timestamp": "2026-09-30"}, None),
        ({"timestamp": "2026-09-30T01:02:03Z"}, None),
        ({"timestamp": "20260930T010203"}, None),
        ({"timestamp": "12:30"}, "bad_timestamp"),
        ({"timestamp": 20260930}, "bad_timestamp"),
        ({"timestamp": None}, "bad_timestamp"),
        ({"vehicle_id": 7}, "bad_vehicle_id"),
        ({"vehicle_id": None}, "bad_vehicle_id"),
        ({"vehicle_id": ["V1"]}, "bad_vehicle_id"),
        ({"latitude": 91}, "bad_latitude"),
        ({"latitude": "12.5d"}, "bad_latitude"),
        ({"latitude": None}, "bad_latitude"),
        ({"longitude": -180.5}, "bad_longitude"),
        ({"speed": -1}, "bad_speed"),
        ({"speed": "abc"}, "bad_speed"),
        ({"speed": "nan"}, "bad_speed"),
    ],
)
def test_position_rules(spark, change, want):
    assert reason(spark, line({**GOOD, **change})) == want


@pytest.mark.parametrize("name", sorted(GOOD))
def test_missing_field(spark, name):
    assert reason(spark, line(without(GOOD, name))) == "missing_field"


@pytest.mark.parametrize(
    "text, want",
    [
        ("{not json", "malformed_json"),
        ("[1, 2]", "missing_event"),
        ('"text"', "missing_event"),
        ('{"kafka_topic":"gps-events"}', "missing_event"),
        ('{"event":null}', "missing_field"),
        ('{"event":[1]}', "missing_field"),
        ('{"event":"vehicle_id"}', "missing_field"),
        ('{"event":{}}', "missing_field"),
    ],
)
def test_lines_without_event(spark, text, want):
    assert reason(spark, text) == want


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, None),
        *[({"status": s}, None) for s in silver.DELIVERY_STATUSES],
        ({"status": "Delivered"}, "bad_status"),
        ({"status": "lost"}, "bad_status"),
        ({"status": None}, "bad_status"),
        ({"order_id": 5}, "bad_order_id"),
        ({"location": 5}, "bad_location"),
    ],
)
def test_delivery_rules(spark, change, want):
    assert reason(spark, line({**ORDER, **change}), silver.DELIVERY_RULES) == want


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, None),
        ({"fuel_level": 0}, None),
        ({"fuel_level": 100}, None),
        ({"fuel_level": 100.01}, "bad_fuel_level"),
        ({"fuel_level": -0.01}, "bad_fuel_level"),
        ({"engine_status": "on"}, "bad_engine_status"),
        ({"engine_status": "OFF"}, None),
    ],
)
def test_vehicle_rules(spark, change, want):
    assert reason(spark, line({**STATE, **change}), silver.VEHICLE_RULES) == want


def test_blank_lines_are_skipped(spark):
    assert checked(spark, ["", "   ", line(GOOD)]).count() == 1


def test_unknown_fields_and_lineage_survive(spark):
    event = {**GOOD, "extra": {"deep": [1, 2]}, "_offset": "mine"}
    row = silver.accepted(checked(spark, [line(event, 9)])).select("*", F.to_json("event").alias("text")).collect()[0]
    assert json.loads(row.text)["extra"] == {"deep": [1, 2]}
    assert (row._kafka_topic, row._partition, row._offset) == ("gps-events", 0, 9)


def test_quarantine_keeps_the_text(spark):
    rows = silver.rejected(checked(spark, ["{not json", line({**GOOD, "speed": -1}, 3)])).collect()
    assert {(r.reject_reason, r.raw) for r in rows} == {("malformed_json", "{not json"), ("bad_speed", None)}
    assert silver.topic_counts(checked(spark, [line(GOOD), line({**GOOD, "speed": -1})])).collect()[0][1:] == (1, 1)


def test_dedup_keeps_the_lowest_offset(spark):
    lines = [line({**GOOD, "speed": s}, o) for s, o in ((1, 30), (2, 10), (3, 20))]
    lines.append(line({**GOOD, "speed": 4, "timestamp": "2026-09-30T06:32:03+05:30"}, 40))
    lines.append(line({**GOOD, "timestamp": "2026-09-30T01:02:04Z", "speed": 9}, 50))
    envelopes = bronze.envelope_from_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r.speed for r in silver.silver_gps(envelopes).collect()) == [2.0, 9.0]


def test_own_rules(spark):
    rules = silver.TopicRules("door-events", {"vehicle_id": "text", "open": "number"}, lambda: {"open": F.col("open") < 2})
    assert reason(spark, line({"vehicle_id": "V1", "open": 1}), rules) is None
    assert reason(spark, line({"vehicle_id": "V1", "open": 2}), rules) == "bad_open"


def test_json_is_parsed_once(spark, tmp_path):
    """Filters on the outcome and on the topic must stay above the parsing."""
    (tmp_path / "in.txt").write_text(line(GOOD))
    from_lines = bronze.envelope_from_lines(bronze.read_lines(spark, str(tmp_path / "in.txt")))
    spark.createDataFrame([("gps-events", 0, 1, json.dumps(GOOD))], bronze.MESSAGE).write.parquet(str(tmp_path / "in"))
    from_messages = bronze.envelope_from_messages(spark.read.parquet(str(tmp_path / "in")))
    for envelopes in (from_lines, from_messages):
        one_topic = envelopes.where(F.col("kafka_topic") == "gps-events")
        good = silver.accepted(silver.check_events(one_topic, silver.GPS_RULES))
        plan = good._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(value") == 1
        assert good.count() == 1


def test_track_order_splits_one_vehicle(spark):
    rows = spark.range(10_000).selectExpr("'V1' AS vehicle_id", "timestamp_seconds(id * 7919 % 10007) AS timestamp")
    ordered = silver.in_track_order(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or Spark would join parts as small as these
    try:
        sizes = ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("timestamp"), F.max("timestamp"))
        parts = sorted(tuple(r)[1:] for r in sizes.orderBy("min(timestamp)").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and sum(p[0] for p in parts) == 10_000
    times = [r.timestamp for r in ordered.collect()]
    assert times == sorted(times)


def test_clean_tracks_take_one_shuffle(spark):
    rows = spark.range(10_000).selectExpr(
        "concat('V', id % 3) AS vehicle_id", "timestamp_seconds(id * 7919 % 4001) AS timestamp", "id AS _offset", "0 AS _partition"
    )
    clean = silver.clean_tracks(rows)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan
    got = [(r.vehicle_id, r.timestamp, r._offset) for r in clean.collect()]
    assert got == sorted((r.vehicle_id, r.timestamp, r._offset) for r in silver.dedup_positions(rows).collect())
