from datetime import datetime, timedelta

from pyspark.sql import functions as F

from convoy.operators import latest, lookup, serving

T0 = datetime(2026, 1, 1)
GPS = "gps_key bigint, vehicle_id string, timestamp timestamp, latitude double, longitude double, speed double"


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def gps(spark, *rows):
    """Rows of key, vehicle, minute and speed."""
    return spark.createDataFrame([(k, v, at(m), 1.0 * k, 2.0 * k, s) for k, v, m, s in rows], GPS)


def test_latest_row_breaks_ties_and_puts_missing_times_last(spark):
    df = gps(spark, (1, "A", 5, 1.0), (2, "A", 5, 2.0), (3, "A", None, 3.0), (4, "B", None, 4.0), (5, None, 1, 5.0))
    rows = {r.vehicle_id: r.gps_key for r in latest.latest_row(df, [F.col("gps_key").desc()]).collect()}
    assert rows == {"A": 2, "B": 4, None: 5}


def test_latest_ties_keeps_all_and_drops_missing(spark):
    df = gps(spark, (1, "A", 5, 1.0), (2, "A", 5, 2.0), (3, "A", 4, 3.0), (4, "B", None, 4.0), (5, None, 9, 5.0))
    assert sorted(r.gps_key for r in latest.latest_ties(df).collect()) == [1, 2]


def test_latest_ties_with_a_third_of_all_rows_being_copies(spark):
    hot = spark.range(20_000).selectExpr(
        "id AS gps_key", "'A' AS vehicle_id", "timestamp_seconds(1000) AS timestamp", "1D AS latitude", "1D AS longitude", "1D AS speed"
    )
    cold = spark.range(40_000).selectExpr(
        "id AS gps_key", "concat('C', id % 100) AS vehicle_id", "timestamp_seconds(id % 977) AS timestamp", "1D AS latitude",
        "1D AS longitude", "1D AS speed",
    )
    both = hot.unionByName(cold).repartition(16)
    got = latest.latest_ties(both).groupBy("vehicle_id").count().collect()
    want = {}
    for i in range(40_000):
        v, t = f"C{i % 100}", i % 977
        best, n = want.get(v, (-1, 0))
        want[v] = (t, 1) if t > best else (best, n + (t == best))
    assert {r.vehicle_id: r["count"] for r in got} == {"A": 20_000, **{v: n for v, (_, n) in want.items()}}


def test_live_fleet_and_filters(spark):
    vehicles = spark.createDataFrame([("A", "van", "m", "D1"), ("B", "bus", "m", "D1"), ("C", "bus", "m", None)],
                                     "vehicle_id string, type string, model string, depot_id string")
    live = latest.live_fleet(vehicles, gps(spark, (1, "A", 1, 50.0), (2, "A", 2, 0.0), (3, "B", 1, 3.0), (4, "X", 9, 9.0)))
    assert [(r.vehicle_id, r.speed) for r in live.collect()] == [("A", 0.0), ("B", 3.0)]
    assert [r.vehicle_id for r in serving.filter_fleet(live, status="Idle").collect()] == ["B"]
    assert [r.status for r in serving.filter_fleet(live, vehicle_id="A").collect()] == ["Stopped"]
    assert serving.filter_fleet(live).count() == 2
    assert serving.filter_fleet(live, vehicle_id="A", status="Moving").count() == 0


def test_fleet_status_counts_missing_speed_as_stopped(spark):
    df = gps(spark, (1, "A", 1, 50.0), (2, "A", 2, None), (3, "B", 1, 5.0), (4, "C", 1, 5.5), (5, "D", 1, 0.0))
    assert tuple(serving.fleet_status(df).collect()[0]) == (1, 1, 2, 4)


def test_silver_latest_takes_the_first_of_equal_times(spark):
    df = gps(spark, (7, "A", 3, 1.0), (5, "A", 3, 2.0), (9, "A", 1, 3.0)).withColumns(
        {"_offset": F.col("gps_key"), "_partition": F.lit(0)}
    )
    assert [r.gps_key for r in latest.latest_silver(df).collect()] == [5]


def test_trail_keeps_the_last_points_in_order(spark):
    rows = [(k, "A", k, 1.0) for k in range(20)] + [(50, "B", 1, 1.0), (60, "", 1, 1.0), (61, None, 1, 1.0)]
    df = gps(spark, *rows).withColumn("latitude", F.when(F.col("gps_key") != 19, F.col("latitude")))
    got = {r.vehicle_id: [p.latitude for p in r.trail] for r in latest.trails(df, "gps_key").collect()}
    assert got == {"A": [float(k) for k in range(4, 19)], "B": [50.0]}
    assert [r.vehicle_id for r in latest.trails(df, "gps_key", min_points=2).collect()] == ["A"]


def test_last_scan(spark):
    orders = spark.createDataFrame([("O1",), ("O2",), ("O3",)], "order_id string")
    scans = spark.createDataFrame(
        [("O1", at(1), "picked_up", "x"), ("O1", at(3), "delivered", "y"), ("O2", at(1), "delayed", "a"), ("O2", at(1), "delayed", "b")],
        "order_id string, scan_time timestamp, scan_status string, location string",
    )
    rows = {r.order_id: (r.scan_time, r.scan_status, r.location) for r in lookup.attach_last_scan(orders, scans).collect()}
    assert rows == {"O1": (at(3), "delivered", "y"), "O2": (at(1), "delayed", "b"), "O3": (None, "", "")}


def test_overspeed_list_and_counter(spark):
    df = gps(spark, *[(k, "A", k, 60.0 + k) for k in range(30)], (90, "N", 1, float("nan")))
    top = serving.overspeed_alerts(df, [F.col("gps_key")])
    assert [r.speed for r in top.collect()] == [89.0 - k for k in range(10)]
    deliveries = spark.createDataFrame([("delayed",), ("Delayed",)], "scan_status string")
    assert serving.alert_counters(df, df, deliveries).collect()[0].asDict() == {
        "overspeed": 10, "overspeed_total": 19, "stopped": 1, "idle": 0, "delayed": 1,
    }


def test_bounding_box_ignores_unplaced(spark):
    df = gps(spark, (1, "A", 1, 1.0), (5, "B", 1, 1.0)).union(gps(spark, (9, "C", 1, 1.0)).withColumn("latitude", F.lit(None).cast("double")))
    assert tuple(serving.bounding_box(df).collect()[0]) == (1.0, 5.0, 2.0, 10.0)


def test_orphans_count_missing_keys(spark):
    facts = spark.createDataFrame([("A",), ("A",), ("B",), (None,), ("X",), ("X",)], "vehicle_id string")
    dim = spark.createDataFrame([("A",), ("B",)], "vehicle_id string")
    assert lookup.orphan_count(facts, dim, "vehicle_id", "vehicle_id").collect()[0].orphans == 3
    assert {(r.key, r.rows) for r in lookup.orphan_keys(facts, dim, "vehicle_id", "vehicle_id").collect()} == {(None, 1), ("X", 2)}
    assert lookup.orphan_count(facts.limit(0), dim, "vehicle_id", "vehicle_id").collect()[0].orphans == 0
