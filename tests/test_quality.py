import pytest

from convoy.operators import quality
from convoy.schemas import TABLES, table_schema


@pytest.fixture
def tables(spark):
    """Empty tables but for a few rows that break a known number of rules."""
    made = {t: spark.createDataFrame([], table_schema(t)) for t in TABLES}

    def fill(table, *rows):
        names = [f.name for f in table_schema(table)]
        made[table] = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], table_schema(table))

    fill("dim_vehicle", {"vehicle_id": "A"}, {"vehicle_id": "A"}, {"vehicle_id": None}, {"vehicle_id": None}, {"vehicle_id": ""})
    fill(
        "fact_gps",
        {"vehicle_id": "A", "latitude": 90.0, "longitude": 180.0, "speed": 0.0},
        {"vehicle_id": "X", "latitude": 90.1, "longitude": -180.1, "speed": -1.0},
        {"vehicle_id": None, "speed": 200.5},
    )
    fill("fact_fuel", {"vehicle_id": "A", "liters": 0.0, "amount": -0.5}, {"vehicle_id": "", "liters": 1.0})
    fill("fact_vehicle_telemetry", {"fuel_level_percent": 100.5, "remaining_fuel_liters": -1.0}, {"fuel_level_percent": -0.5})
    fill("fact_maintenance", {"work_order_id": "W", "vehicle_id": "A", "cost": -1.0, "downtime_hours": -0.01})
    return made


def by_name(df):
    return {(r.check_family, r.check_name): (r.value, r.status) for r in df.collect()}


def test_row_checks(tables):
    got = by_name(quality.row_checks(tables))
    assert len(got) == 12 + 8 + 9
    assert got["volume", "dim_vehicle"] == (5, "PASS") and got["volume", "dim_depot"] == (0, "FAIL")
    assert got["completeness", "dim_vehicle.vehicle_id"] == (3, "FAIL")
    assert got["completeness", "fact_fuel.vehicle_id"] == (1, "FAIL")
    assert got["completeness", "fact_delivery.order_id"] == (0, "PASS")
    for name in ("GPS latitude", "GPS longitude", "GPS speed", "Fuel liters", "Fuel amount", "Telemetry remaining fuel",
                 "Maintenance cost", "Maintenance downtime"):
        assert got["range", name] == (1, "FAIL"), name
    assert got["range", "Telemetry fuel %"] == (2, "FAIL")


def test_uniqueness_counts_missing_keys_as_excess(tables):
    rows = {r.check_name: r for r in quality.uniqueness_checks(tables).collect()}
    assert len(rows) == 6
    assert (rows["dim_vehicle.vehicle_id"].value, rows["dim_vehicle.vehicle_id"].duplicate_keys) == (3, 2)
    assert rows["dim_driver.driver_id"].value == 0 and rows["dim_driver.driver_id"].status == "PASS"


def test_references_and_all_checks(tables):
    got = by_name(quality.reference_checks(tables))
    assert len(got) == 7 and got["reference", "gps -> vehicle"] == (2, "FAIL")
    assert got["reference", "fuel -> vehicle"] == (0, "PASS")
    assert quality.all_checks(tables).count() == 42


def test_health_summary(tables):
    names = ("dim_vehicle", "fact_gps", "fact_delivery", "fact_fuel", "fact_maintenance")
    row = quality.health_summary(*(tables[n] for n in names)).collect()[0]
    assert (row.vehicle_count, row.null_vehicle_ids, row.duplicate_vehicle_ids) == (5, 2, 2)
    assert (row.invalid_gps_vehicle_references, row.invalid_gps_speed) == (2, 2)
    assert row.status == "warning"
    assert row.failed_checks == [
        "null_vehicle_ids", "duplicate_vehicle_ids", "invalid_gps_vehicle_references", "invalid_gps_speed", "delivery_count",
    ]


def test_healthy(spark, tables):
    good = {t: tables[t].where("vehicle_id = 'A'") for t in ("fact_fuel", "fact_maintenance")}
    vehicles = tables["dim_vehicle"].where("vehicle_id = 'A'").limit(1)
    gps = tables["fact_gps"].where("vehicle_id = 'A'")
    deliveries = spark.createDataFrame([("O1",)], "order_id string")
    row = quality.health_summary(vehicles, gps, deliveries, good["fact_fuel"], good["fact_maintenance"]).collect()[0]
    assert row.status == "healthy" and row.failed_checks == []


def test_keys_that_break_a_load(tables):
    assert {(r.key, r.rows) for r in quality.bad_keys(tables["dim_vehicle"], "vehicle_id").collect()} == {("A", 2), (None, 2), ("", 1)}
    assert {(r.key, r.rows) for r in quality.duplicate_keys(tables["dim_vehicle"], "vehicle_id").collect()} == {("A", 2), (None, 2)}


def test_unique_keys_are_dealt_to_many_tasks_and_not_combined_before(spark, tables):
    """A task that combined its rows first would hold them all, since hardly any key repeats."""
    plan = quality.uniqueness_checks(tables)._jdf.queryExecution().executedPlan().toString()
    dealt = next(i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(check" in line and "key" in line)
    assert "REPARTITION_BY_NUM" in plan.splitlines()[dealt]
    assert not any("Aggregate" in line for line in plan.splitlines()[dealt:])
    got = {r.check_name: (r.value, r.duplicate_keys) for r in quality.uniqueness_checks(tables).collect()}
    assert got["dim_vehicle.vehicle_id"] == (3, 2) and got["fact_maintenance.work_order_id"] == (0, 0)
