import datetime

import pytest
from pyspark.sql import functions as F

from convoy.plans.kpi_views import VIEWS, publish_kpis
from convoy.plans.warehouse import build_warehouse, load_faults, raw_tables
from convoy.schemas import TABLES, table_schema
from convoy.sources.tables import LoadError, as_declared, copy_tables, fingerprints, read_table, write_table

FILES = {
    "depots.csv": "depot_id,depot_name,city,capacity\nD1,North,Berlin,10\n",
    "vehicles.csv": "vehicle_id,type,depot,capacity,model,fuel_capacity_liters,extra\nV1,van,D1,3,\"Big, \"\"blue\"\"\",60.5,x\nV2,bus,,,,\n",
    "drivers.csv": "driver_id,name,depot,experience_years,shift\nP1,Ann,D1,4,Night\n",
    "routes.csv": "destination,route_id,origin,distance_km\nb,R2,a,10.5\nb,R1,a,\n",
    "customers.csv": "customer_id,customer_name,city,service_area\nC1,Shop,Berlin,Mitte\n",
    "orders.csv": (
        "order_id,customer_id,route_id,vehicle_id,driver_id,promised_time,status\n"
        "O1,C1,R1,V1,P1,2026-09-30T10:00:00,delivered\nO2,C1,R1,V1,P1,2026-09-30T11:00:00,delayed\nO3,C1,R2,V2,P1,,x\n"
    ),
    "delivery_scans.csv": (
        "order_id,scan_time,status,location\nO1,2026-09-30T09:00:00,delivered,Berlin\nO1,2026-09-30T08:00:00,picked_up,Bonn\n"
    ),
    "fuel.csv": "vehicle_id,timestamp,liters,amount,fuel_type,odometer_km\nV1,2026-09-30T08:00:00,10,15.5,diesel,100\nV1,2026-10-01T08:00:00,,n/a,diesel,180\nV1\n",
    "maintenance.csv": "work_order_id,vehicle_id,issue,opened_at,closed_at,priority,cost\nW1,V1,brakes,2026-09-30T08:00:00,2026-10-01T08:30:00,High,99.5\n",
    "gps.csv": "vehicle_id,timestamp,latitude,longitude,speed\nV1,2026-09-30T08:00:00,52.5,13.4,41.5\nV1,2026-09-30T08:01:00,52.6,13.4,\n",
    "vehicle_telemetry.csv": "vehicle_id,timestamp,engine_status,fuel_level_percent,remaining_fuel_liters,odometer_km\nV1,2026-09-30T08:00:00,ON,50,30,100\n",
}


def write_files(folder, **changed):
    for name, text in {**FILES, **{f"{k}.csv": v for k, v in changed.items()}}.items():
        (folder / name).write_text(text)
    return str(folder)


def test_raw_files_are_typed_by_header_name(spark, tmp_path):
    tables = raw_tables(spark, write_files(tmp_path))
    assert tuple(tables) == TABLES
    for name, df in tables.items():
        want = {f.name: f.dataType.simpleString() for f in table_schema(name)}
        assert {k: v for k, v in df.dtypes if k in want} == want, name
    vehicle = {r.vehicle_id: r for r in tables["dim_vehicle"].collect()}
    assert vehicle["V1"].model == 'Big, "blue"' and vehicle["V1"].depot_id == "D1" and vehicle["V1"].capacity == 3
    assert vehicle["V2"].depot_id is None and vehicle["V2"].capacity is None
    route = {r.route_id: r for r in tables["dim_route"].orderBy("route_key").collect()}
    assert list(route) == ["R2", "R1"] and route["R2"].distance_km == 10.5
    assert route["R1"].distance_km is None and route["R1"].expected_duration_min is None
    fuel = tables["fact_fuel"].orderBy("fuel_key").collect()
    assert [(r.liters, r.amount, r.odometer_km) for r in fuel] == [(10.0, 15.5, 100.0), (None, None, 180.0), (None, None, None)]


def test_numbers_line_breaks_and_what_can_not_be_read(spark, tmp_path):
    from convoy.sources.csv import LOADS, load_csv, typed, unreadable

    texts = ["9007199254740993", "12.7", "12.0", "1e3", " 7 ", "", "x", None, "9223372036854775808"]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in rows.select(typed(F.col("x"), "bigint")).collect()]
    assert got == [9007199254740993, None, 12, 1000, 7, None, None, None, None]
    raw = write_files(tmp_path, depots='depot_id,depot_name,city,capacity\nD1,"North\nGate",Berlin,ten\nD2,South,Bonn,\n')
    load = next(load for load in LOADS if load.table == "dim_depot")
    depots = {r.depot_id: r for r in load_csv(spark, raw, load).collect()}
    assert set(depots) == {"D1", "D2"} and depots["D1"].depot_name == "North\nGate"
    assert {r["column"]: r["values"] for r in unreadable(spark, raw, load).collect()}["capacity"] == 1


def test_orders_get_their_last_scan_and_dates(spark, tmp_path):
    tables = raw_tables(spark, write_files(tmp_path))
    rows = {r.order_id: r for r in tables["fact_delivery"].collect()}
    assert rows["O1"].scan_status == "delivered" and rows["O1"].location == "Berlin"
    assert rows["O2"].scan_status == "" and rows["O2"].scan_time is None
    dates = [r.asDict() for r in tables["dim_date"].collect()]
    assert dates == [{"date_key": 20260930, "date": "2026-09-30", "year": 2026, "month": 9, "day": 30, "quarter": 3}]
    assert tables["fact_maintenance"].collect()[0].downtime_hours == 24.5
    assert tables["fact_trip"].count() == 2


def test_rebuild_replaces_the_warehouse(spark, tmp_path):
    raw, root = write_files(tmp_path), str(tmp_path / "wh")
    build_warehouse(spark, raw, root)
    counts = build_warehouse(spark, raw, root)
    assert counts["dim_vehicle"] == 2 and counts["fact_gps"] == 2 and len(counts) == 12
    gps = read_table(spark, root, "fact_gps")
    assert gps.select("event_date").distinct().collect()[0][0] == datetime.date(2026, 9, 30)
    views = publish_kpis({t: read_table(spark, root, t) for t in TABLES})
    assert set(views) == set(VIEWS) and len(VIEWS) == 10
    assert spark.sql("SELECT km_per_liter FROM vw_fuel_efficiency").collect()[0][0] == 8.0
    build_warehouse(spark, raw, root)
    assert len(list((tmp_path / "wh" / "_versions").iterdir())) == 2  # the newest and the one before


@pytest.mark.parametrize("step", ["_stage", "_reconcile", "bad_keys", "_commit", "move", "write_text", "drop"])
def test_a_rebuild_that_fails_leaves_all_old_or_all_new_tables(spark, tmp_path, monkeypatch, step):
    from convoy.sources import files
    from convoy.sources import tables as module

    root, keys = str(tmp_path / "wh"), {"dim_depot": "depot_id", "dim_driver": "driver_id"}

    def build(rows):
        depots, drivers = (spark.range(rows).selectExpr(f"concat('K', id) AS {key}") for key in keys.values())
        module.rebuild_tables(spark, {"dim_depot": depots, "dim_driver": drivers, "copy": module.View("dim_depot")}, root, keys)

    def seen():
        return tuple(read_table(spark, root, t).count() for t in ("dim_depot", "dim_driver", "copy"))

    build(1)
    build(1)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(files if hasattr(files, step) else module, step, fail)
        with pytest.raises(OSError, match="lost"):
            build(2)
    assert seen() == ((2, 2, 2) if step == "drop" else (1, 1, 1))
    build(2)
    assert seen() == (2, 2, 2)


@pytest.mark.parametrize("bad", ["V1,van,D1,3,m,60.5,x\nV1,bus,D1,3,m,60.5,x\n", ",van,D1,3,m,60.5,x\n"])
def test_missing_or_repeated_key_stops_the_load(spark, tmp_path, bad):
    raw, root = write_files(tmp_path, vehicles=FILES["vehicles.csv"].split("\n")[0] + "\n" + bad), str(tmp_path / "wh")
    with pytest.raises(LoadError, match="dim_vehicle.vehicle_id"):
        build_warehouse(spark, raw, root)
    assert not (tmp_path / "wh" / "_commits").exists() and not list((tmp_path / "wh" / "_versions").iterdir())


def test_copy_refuses_a_taken_place(spark, tmp_path):
    one, two = spark.range(5), spark.range(7)
    root = str(tmp_path / "copy")
    assert copy_tables(spark, {"b": two}, root) == {"b": 7}
    with pytest.raises(LoadError, match="already there"):
        copy_tables(spark, {"a": one, "b": two}, root)
    assert not (tmp_path / "copy" / "a").exists()
    assert spark.read.parquet(f"{root}/b").count() == 7


def test_copy_with_other_counts_leaves_nothing(spark, tmp_path, monkeypatch):
    from convoy.sources import tables as module

    monkeypatch.setattr(module, "_write_as_is", lambda df, path, table: df.where("id > 0").write.parquet(path))
    with pytest.raises(LoadError, match="a: 5 rows read, 4 written"):
        copy_tables(spark, {"a": spark.range(5)}, str(tmp_path / "copy"))
    assert [p for p in (tmp_path / "copy").iterdir()] == []


def test_facts_are_sorted_within_their_day(spark, tmp_path):
    rows = spark.range(5000).selectExpr(
        "concat('V', id * 31 % 97) AS vehicle_id", "timestamp_seconds(1700000000 + id * 7919 % 300000) AS timestamp", "1D AS speed"
    )
    write_table(rows, str(tmp_path / "fact_gps"), "fact_gps")
    back = read_table(spark, str(tmp_path), "fact_gps")
    assert back.count() == 5000
    wrong = back.where("event_date != to_date(timestamp)").count()
    assert wrong == 0
    for day in (tmp_path / "fact_gps").glob("event_date=*"):
        for file in day.glob("*.parquet"):
            got = [(r.vehicle_id, r.timestamp) for r in spark.read.parquet(str(file)).collect()]
            assert got == sorted(got)


def test_a_day_with_most_rows_is_cut_into_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(200_000, numPartitions=16).selectExpr(
            "concat('V', id % 97) AS vehicle_id",
            "timestamp_seconds(1700000000 + if(id % 3 < 2, id % 1000, id * 7919 % 300000)) AS timestamp",
            "rand(1) AS speed",
        )
        write_table(rows, str(tmp_path / "fact_gps"), "fact_gps")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [len(list(day.glob("*.parquet"))) for day in (tmp_path / "fact_gps").glob("event_date=*")]
    assert max(files) > 4
    assert read_table(spark, str(tmp_path), "fact_gps").agg(F.count("*")).collect()[0][0] == 200_000


BROKEN_GPS = (
    FILES["gps.csv"]
    + '"V2\nleft\nhere",2026-09-30T08:02:00,52.7,13.4,7\nV3,2026-09-30T08:03:00,52,1,9,too,many\nV4,2026-09-30T08:04:00,52,x,9\n'
    + '"V5 ""big"", old",2026-09-30T08:05:00,52,1,3\n'
)


def test_a_line_break_in_a_fact_is_refused_and_counted(spark, tmp_path):
    """Never two rows of one; short lines of a file without open quotes stay rows."""
    raw, root = write_files(tmp_path, gps=BROKEN_GPS), str(tmp_path / "wh")
    counts = build_warehouse(spark, raw, root)
    assert counts["fact_gps"] == counts["fact_trip"] == 4 and counts["fact_fuel"] == 3
    assert {t: read_table(spark, root, t).count() for t in TABLES} == counts
    trips, gps = read_table(spark, root, "fact_trip"), read_table(spark, root, "fact_gps")
    assert trips.columns == ["trip_key", *gps.columns[1:]] and not list((tmp_path / "wh").rglob("fact_trip/*"))
    assert sorted(map(tuple, trips.collect())) == sorted(map(tuple, gps.collect()))
    rows = {r.vehicle_id: r for r in read_table(spark, root, "fact_gps").collect()}
    assert set(rows) == {"V1", "V4", 'V5 "big", old'} and rows["V4"].longitude is None
    refused = sorted((r.fault, r.line) for r in read_table(spark, root, "load_refused").collect())
    assert [f for f, _ in refused] == ["open_quote", "open_quote", "short", "too_long"] and ("short", "left") in refused
    found = {(r.file, r.fault): r["rows"] for r in read_table(spark, root, "load_faults").collect() if r["rows"]}
    assert found == {
        ("gps.csv", "open_quote"): 2, ("gps.csv", "short"): 1, ("gps.csv", "too_long"): 1, ("gps.csv", "unreadable longitude"): 1,
        ("fuel.csv", "short"): 1, ("fuel.csv", "unreadable amount"): 1,
    }
    assert load_faults(spark, raw).where("rows > 0").count() == 6


def test_customers_are_split_and_other_dimensions_hold_line_breaks(spark, tmp_path):
    from convoy.sources.csv import LOADS

    breaks = {load.file for load in LOADS if load.line_breaks}
    assert breaks == {"depots.csv", "vehicles.csv", "drivers.csv", "routes.csv"}
    raw = write_files(tmp_path, customers='customer_id,customer_name,city,service_area\nC1,"Shop\nNorth",Berlin,Mitte\nC2,Inn,Bonn,Sued\n')
    assert [r.customer_id for r in raw_tables(spark, raw, {"customers.csv"})["dim_customer"].collect()] == ["C2"]


def test_a_copy_with_one_changed_value_is_refused(spark, tmp_path, monkeypatch):
    from convoy.sources import tables as module

    source = spark.range(50).selectExpr("id", "concat('n', id) AS name", "CAST(id AS double) / 3 AS share")
    changes = {
        "share, name": lambda df: df.withColumn("share", F.when(F.col("id") == 7, F.lit(2.5)).otherwise(F.col("share"))).withColumn(
            "name", F.when(F.col("id") == 8, F.lit(None)).otherwise(F.col("name"))
        ),
        "swapped": lambda df: df.withColumn("share", (F.lit(49) - F.col("id")).cast("double") / 3),
    }
    for name, change in changes.items():
        with monkeypatch.context() as patch:
            patch.setattr(module, "_write_as_is", lambda df, path, table, change=change: change(df).write.parquet(path))
            with pytest.raises(LoadError, match=r"written than read in \*(, name, share)?$"):
                copy_tables(spark, {"a": source}, str(tmp_path / "copy"))
        assert not (tmp_path / "copy" / "a").exists(), name
    assert copy_tables(spark, {"a": source}, str(tmp_path / "copy")) == {"a": 50}


def test_fingerprints_do_not_depend_on_order_or_partitions(spark):
    df = spark.range(2000).selectExpr("id", "IF(id % 5 = 0, NULL, concat('x', id % 7)) AS name", "id / 7 AS share")
    first = {r["column"]: r for r in fingerprints(df).collect()}
    second = {r["column"]: r for r in fingerprints(df.orderBy(F.desc("id")).repartition(7)).collect()}
    assert first == second and (first["name"]["rows"], first["name"].filled) == (2000, 1600)
    doubled = {r["column"]: r for r in fingerprints(df.unionAll(df)).collect()}
    assert all(doubled[c].fingerprint == 2 * first[c].fingerprint for c in first)
    assert {r.fingerprint for r in fingerprints(df.limit(0)).collect()} == {0}


def test_a_copy_casts_to_declared_types(spark, tmp_path):
    rows = spark.createDataFrame([("7", "2.5", "x", "2026-09-30 10:00:00")], "a string, b string, c string, d string")
    declared = {"t": {"a": "INTEGER", "b": "DOUBLE PRECISION", "c": "VARCHAR(9)", "d": "TIMESTAMP"}}
    copy_tables(spark, {"t": rows}, str(tmp_path / "copy"), declared)
    copied = spark.read.parquet(str(tmp_path / "copy" / "t"))
    assert [k for _, k in copied.dtypes] == ["bigint", "double", "string", "timestamp"]
    assert copied.first().a == 7
    assert dict(as_declared(rows, {"d": "DATETIME"}).dtypes)["d"] == "date"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        copy_tables(spark, {"u": rows}, str(tmp_path / "copy"), {"u": {"c": "INT"}})
    assert not (tmp_path / "copy" / "u").exists()


def test_a_copy_computes_its_source_once(spark, tmp_path):
    """By the rows that pass, of a source with a shuffle; empty tables and odd names arrive too."""
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    source = spark.range(300).mapInArrow(counted, "id long").repartition(3, "id").selectExpr("id", "IF(id % 5 = 0, NULL, id / 7) AS `a.'b`")
    assert copy_tables(spark, {"a": source, "none": spark.range(0)}, str(tmp_path / "copy")) == {"a": 300, "none": 0}
    assert passed.value == 300
    assert fingerprints(spark.read.parquet(str(tmp_path / "copy" / "a"))).collect() == fingerprints(source).collect()


def test_fingerprints_without_whole_rows(spark):
    df = spark.range(20).selectExpr("id", "IF(id % 5 = 0, NULL, concat('x', id % 7)) AS name")
    assert fingerprints(df, whole=False).collect() == fingerprints(df).where(F.col("column") != "*").collect()
