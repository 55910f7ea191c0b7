import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from convoy.operators import silver
from convoy.plans.refine import read_quarantine, read_silver, read_unrouted, refine_bronze
from convoy.sources import bronze
from convoy.streaming.ingest import write_bronze
from convoy.streaming.live import read_live, write_live
from convoy.sources import files, manifest
from convoy.streaming import live, refine
from convoy.streaming.refine import (
    BatchCounts,
    append_parquet,
    read_stream_counts,
    read_stream_quarantine,
    read_stream_silver,
    stream_quarantine,
    write_silver,
)

T0 = datetime(2026, 9, 30, 8)


def gps_line(offset, vehicle="V1", second=0, speed=10.0, **extra):
    event = {
        "vehicle_id": vehicle, "timestamp": (T0 + timedelta(seconds=second)).isoformat() + "+00:00", "latitude": 1.0,
        "longitude": 2.0, "speed": speed, **extra,
    }
    return json.dumps({"kafka_topic": "gps-events", "partition": 0, "offset": offset, "event": event})


def put(folder, name, lines):
    """Add a file to a watched folder in one move, so that no half of it is read."""
    folder.mkdir(exist_ok=True)
    draft = folder.parent / f"draft-{name}"
    draft.write_text("\n".join(lines) + "\n")
    draft.rename(folder / name)


def batch_rows(spark, folder):
    envelopes = bronze.envelope_from_lines(bronze.read_lines(spark, str(folder)))
    return silver.silver_gps(envelopes)


def keys(df):
    return sorted((r.vehicle_id, r.timestamp, r._offset) for r in df.collect())


@pytest.fixture
def lines(tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.txt", [gps_line(0), gps_line(1, second=1), gps_line(2, second=1), "{broken", "", gps_line(3, speed=-1)])
    return folder


def test_stream_equals_batch_also_after_a_restart(spark, tmp_path, lines):
    def run():
        envelopes = bronze.envelope_from_lines(bronze.stream_lines(spark, str(lines), files_per_trigger=1))
        write_silver(envelopes, silver.GPS_RULES, str(tmp_path / "silver"), str(tmp_path / "cp")).awaitTermination()
        return keys(read_stream_silver(spark, str(tmp_path / "silver"), silver.GPS_RULES))

    assert run() == keys(batch_rows(spark, lines))
    assert run() == keys(batch_rows(spark, lines))
    put(lines, "b.txt", [gps_line(10, second=1), gps_line(11, second=5, extra={"deep": 1}), gps_line(12, "V2", second=5)])
    assert run() == keys(batch_rows(spark, lines))
    assert len(run()) == 4
    put(lines, "c.txt", [gps_line(20, second=-9 * 86400), gps_line(0, second=5), gps_line(21, second=0)])  # days late, lower offset
    assert run() == keys(batch_rows(spark, lines))
    assert len(run()) == 5
    put(lines, "d.txt", [gps_line(11, second=5, extra={"deep": 1}), gps_line(30, second=77, extra={"deep": 1})])
    assert run() == keys(batch_rows(spark, lines))
    kept = spark.read.parquet(str(tmp_path / "silver")).where("_offset = 30").select(F.to_json("event")).collect()[0][0]
    assert json.loads(kept)["extra"] == {"deep": 1}


def test_stream_quarantine(spark, tmp_path, lines):
    envelopes = bronze.envelope_from_lines(bronze.stream_lines(spark, str(lines)))
    bad = stream_quarantine(envelopes, silver.GPS_RULES)
    append_parquet(bad, str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.reject_reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["bad_speed", "malformed_json"]


def test_bronze_keeps_every_message_of_every_topic(spark, tmp_path):
    source = tmp_path / "topics"
    rows = [("gps-events", 0, 1, '{"vehicle_id":"V1"}'), ("vehicle-events", 2, 1, "broken"), ("gps-events", 1, 1, "[]")]
    spark.createDataFrame(rows, bronze.MESSAGE).write.parquet(str(source))

    def run():
        messages = spark.readStream.schema(bronze.MESSAGE).parquet(str(source))
        write_bronze(messages, str(tmp_path / "bronze"), str(tmp_path / "cp")).awaitTermination()

    run()
    run()
    stored = bronze.read_bronze(spark, str(tmp_path / "bronze"))
    assert sorted((r.kafka_topic, r.partition, r.raw) for r in stored.collect()) == [
        ("gps-events", 0, None), ("gps-events", 1, None), ("vehicle-events", 2, "broken"),
    ]
    one = bronze.read_bronze(spark, str(tmp_path / "bronze"), "gps-events")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(kafka_topic" in one._jdf.queryExecution().executedPlan().toString()


def test_bronze_stream_feeds_silver(spark, tmp_path):
    rows = [("gps-events", 0, i, json.dumps(json.loads(gps_line(i, second=i))["event"])) for i in range(5)]
    spark.createDataFrame(rows, bronze.MESSAGE).write.parquet(str(tmp_path / "topics"))
    messages = spark.readStream.schema(bronze.MESSAGE).parquet(str(tmp_path / "topics"))
    write_bronze(messages, str(tmp_path / "bronze"), str(tmp_path / "cp1")).awaitTermination()
    stored = bronze.stream_bronze(spark, str(tmp_path / "bronze"), "gps-events")
    write_silver(stored, silver.GPS_RULES, str(tmp_path / "silver"), str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 5


def test_live_positions_follow_the_newest_event(spark, tmp_path):
    folder = tmp_path / "in"

    def run(every):
        good = silver.accepted(silver.check_events(bronze.envelope_from_lines(bronze.stream_lines(spark, str(folder))), silver.GPS_RULES))
        write_live(good, str(tmp_path / "live"), str(tmp_path / "cp"), every, availableNow=True).awaitTermination()
        return {r.vehicle_id: (r.speed, r.status, r.overspeed) for r in read_live(spark, str(tmp_path / "live")).collect()}

    put(folder, "a.txt", [gps_line(5, "V1", 1, 30.0), gps_line(4, "V1", 1, 40.0), gps_line(6, "V2", 1, 3.0)])
    assert run(2) == {"V1": (40.0, "Moving", False), "V2": (3.0, "Idle", False)}
    put(folder, "b.txt", [gps_line(7, "V1", 2, 90.0), gps_line(8, "V1", 0, 1.0)])
    assert run(2) == {"V1": (90.0, "Moving", True), "V2": (3.0, "Idle", False)}
    assert (tmp_path / "live" / "snapshots").exists()
    put(folder, "c.txt", [gps_line(9, "V3", 3, 0.0)])
    assert run(2) == {"V1": (90.0, "Moving", True), "V2": (3.0, "Idle", False), "V3": (0.0, "Stopped", False)}


def test_refined_tables(spark, tmp_path, lines):
    envelopes = bronze.envelope_from_lines(bronze.read_lines(spark, str(lines)))
    counts = {r.topic: (r.processed, r.rejected) for r in refine_bronze(spark, envelopes, str(tmp_path / "out")).collect()}
    assert counts == {"gps-events": (3, 1), "malformed_json": (0, 1)}
    assert [r.raw for r in read_unrouted(spark, str(tmp_path / "out")).collect()] == ["{broken"]
    assert read_silver(spark, str(tmp_path / "out"), "gps-events").count() == 2
    assert [r.reject_reason for r in read_quarantine(spark, str(tmp_path / "out"), silver.GPS_RULES).collect()] == ["bad_speed"]


def run_stream(spark, tmp_path, folder, **options):
    envelopes = bronze.envelope_from_lines(bronze.stream_lines(spark, str(folder), files_per_trigger=1))
    write_silver(envelopes, silver.GPS_RULES, str(tmp_path / "silver"), str(tmp_path / "cp"), **options).awaitTermination()
    return read_stream_silver(spark, str(tmp_path / "silver"), silver.GPS_RULES)


def data_files(path):
    return [p for p in path.rglob("*.parquet") if "_log" not in p.parts]


def test_files_do_not_grow_with_the_batches(spark, tmp_path):
    """Eighteen micro-batches over two days: folders and log stay bounded, no table stays cached, and the rows are the batch's."""
    folder, sizes = tmp_path / "in", []
    for part in range(2):
        for i in range(9):
            k = 9 * part + i
            put(folder, f"{k:03}.txt", [gps_line(10 * k, "V1", 60 * k), gps_line(10 * k + 1, "V2", 60 * k - 86400), "{broken"])
        stored = run_stream(spark, tmp_path, folder, delay=100, compact_at=3, retain=2)
        assert keys(stored) == keys(batch_rows(spark, folder))
        number, state = manifest.newest(spark, str(tmp_path / "silver"))
        sizes.append((len(state["entries"]), len(list((tmp_path / "silver").iterdir())), len(list((tmp_path / "silver" / "_log").glob("[0-9]*")))))
    assert sizes[1][0] <= 3 * 2 * 4 and sizes[1][1] <= sizes[0][1] + 6 and sizes[1][2] <= 2
    assert len(data_files(tmp_path / "silver")) <= 40
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    bad = read_stream_quarantine(spark, str(tmp_path / "silver"), silver.GPS_RULES)
    assert bad.count() == 18 and {r.reject_reason for r in bad.collect()} == {"malformed_json"}


def test_only_late_events_read_the_days_they_fall_on(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.txt", [gps_line(i, "V1", 86400 * i) for i in range(4)])
    run_stream(spark, tmp_path, folder)
    _, state = manifest.newest(spark, str(tmp_path / "silver"))
    entries, edge = state["entries"], state["high"] - 600_000_000
    assert [e["part"] for e in refine.to_compare(entries, edge, [])] == ["2026-10-03"]
    assert sorted(e["part"] for e in refine.to_compare(entries, edge, ["2026-09-30"])) == ["2026-09-30", "2026-10-03"]


def test_a_reader_sees_the_table_before_or_after_a_merge(spark, tmp_path):
    folder = tmp_path / "in"
    for i in range(4):
        put(folder, f"{i}.txt", [gps_line(i, "V1", i)])
    before = run_stream(spark, tmp_path, folder, compact_at=100)
    want, path = keys(before), str(tmp_path / "silver")
    number, state = manifest.newest(spark, path)
    refine._compact(spark, silver.GPS_RULES, path, state["entries"], number, state, retain=5)
    assert keys(before) == want  # planned with the folders that the merge replaced
    assert keys(read_stream_silver(spark, path, silver.GPS_RULES)) == want
    assert len(manifest.newest(spark, path)[1]["entries"]) == 1


@pytest.mark.parametrize("step", ["commit", "move", "sweep"])
def test_a_stream_that_dies_at_a_commit_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, step):
    folder = tmp_path / "in"
    for i in range(5):
        put(folder, f"{i}.txt", [gps_line(2 * i, "V1", i), gps_line(2 * i + 1, "V2", i), gps_line(3, "V2", 1)])
    calls = iter(range(100))

    def dies(*args, **kwargs):
        if next(calls) == (3 if step != "sweep" else 0):
            raise OSError("lost")
        return known(*args, **kwargs)

    owner = files if step == "move" else manifest
    known = getattr(owner, step)
    with monkeypatch.context() as patch:
        patch.setattr(owner, step, dies)
        with pytest.raises(Exception, match="lost"):
            run_stream(spark, tmp_path, folder, compact_at=2, retain=1)
    stored = run_stream(spark, tmp_path, folder, compact_at=2, retain=1)
    assert keys(stored) == keys(batch_rows(spark, folder))
    counts = {r.reject_reason: r.events for r in read_stream_counts(spark, str(tmp_path / "silver"), silver.GPS_RULES).collect()}
    assert counts == {None: 15}


def test_two_writers_can_not_commit_the_same_number(spark, tmp_path):
    root = str(tmp_path / "log")
    assert manifest.commit(spark, root, 0, {"folders": []}) == 1
    with pytest.raises(manifest.CommitConflict):
        manifest.commit(spark, root, 0, {"folders": ["x"]})
    assert manifest.newest(spark, root) == (1, {"folders": [], "retired": []})


def test_counts_come_with_every_batch(spark, tmp_path, lines):
    put(lines, "b.txt", [gps_line(10, second=1), gps_line(11, second=5, speed=-3), "[]"])
    seen = []
    listener = BatchCounts(lambda name, batch, processed, rejected: seen.append((batch, processed, rejected)))
    spark.streams.addListener(listener)
    try:
        run_stream(spark, tmp_path, lines)
        for _ in range(100):
            if len(seen) >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    envelopes = bronze.envelope_from_lines(bronze.read_lines(spark, str(lines)))
    checked = silver.check_events(envelopes, silver.GPS_RULES)
    want = {r.reject_reason: r["n"] for r in checked.groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    counts = read_stream_counts(spark, str(tmp_path / "silver"), silver.GPS_RULES)
    assert {r.reject_reason: r.events for r in counts.collect()} == want
    assert sum(p for _, p, _ in seen) == want[None] and sum(r for _, _, r in seen) == sum(want.values()) - want[None]


def test_live_folders_stay_bounded(spark, tmp_path):
    folder, path = tmp_path / "in", tmp_path / "live"
    for i in range(14):
        put(folder, f"{i:03}.txt", [gps_line(i, f"V{i % 3}", i, 10.0 + i)])
    lines = bronze.stream_lines(spark, str(folder), files_per_trigger=1)
    good = silver.accepted(silver.check_events(bronze.envelope_from_lines(lines), silver.GPS_RULES))
    live.write_live(good, str(path), str(tmp_path / "cp"), 3, retain=2, availableNow=True).awaitTermination()
    held = read_live(spark, str(path))
    assert {r.vehicle_id: r.speed for r in held.collect()} == {"V0": 22.0, "V1": 23.0, "V2": 21.0}
    assert len(list((path / "changes").iterdir())) <= 6 and len(list((path / "snapshots").iterdir())) <= 2
    number, state = manifest.newest(spark, str(path))
    live._snapshot(spark, str(path), number, retain=2)
    assert {r.vehicle_id: r.speed for r in held.collect()} == {"V0": 22.0, "V1": 23.0, "V2": 21.0}


def test_new_positions_meet_stored_ones_without_being_dealt_anew(spark, tmp_path, lines):
    """Positions are dealt by vehicle and instant to find the lowest of each; the comparison goes on from there."""
    stored = run_stream(spark, tmp_path, lines)
    _, state = manifest.newest(spark, str(tmp_path / "silver"))
    put(tmp_path / "more", "b.txt", [gps_line(9), gps_line(10, second=2), gps_line(-1, second=1), "{broken"])
    envelopes = bronze.envelope_from_lines(bronze.read_lines(spark, str(tmp_path / "more")))
    held = silver.check_events(envelopes, silver.GPS_RULES).withColumn("part", refine._part())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = refine._without_stored(spark, silver.GPS_RULES, str(tmp_path / "silver"), held, None, [], state["entries"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        good = rows.where("reject_reason IS NULL")
        assert sorted(r._offset for r in good.collect()) == [-1, 10] and rows.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert stored.count() == 2
    assert plan.count("Exchange hashpartitioning") == 2 and "hashpartitioning(part" not in plan
