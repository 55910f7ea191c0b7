"""Table columns, keys and event fields of the fleet model."""

from __future__ import annotations

from pyspark.sql import types as T

# The 12 warehouse tables, in load order, with their columns.
TABLE_COLUMNS: dict[str, str] = {
    "dim_depot": "depot_key bigint, depot_id string, depot_name string, city string, capacity bigint",
    "dim_vehicle": "vehicle_key bigint, vehicle_id string, type string, depot_id string, capacity bigint, "
    "model string, fuel_capacity_liters double",
    "dim_driver": "driver_key bigint, driver_id string, name string, depot_id string, experience_years bigint, "
    "shift string",
    "dim_route": "route_key bigint, route_id string, origin string, destination string, distance_km double, "
    "expected_duration_min double",
    "dim_customer": "customer_key bigint, customer_id string, customer_name string, city string, service_area string",
    "dim_date": "date_key int, date string, year int, month int, day int, quarter int",
    "fact_trip": "trip_key bigint, vehicle_id string, timestamp timestamp, latitude double, longitude double, "
    "speed double",
    "fact_delivery": "delivery_key bigint, order_id string, customer_id string, route_id string, vehicle_id string, "
    "driver_id string, promised_time timestamp, status string, scan_time timestamp, scan_status string, "
    "location string",
    "fact_fuel": "fuel_key bigint, vehicle_id string, timestamp timestamp, liters double, amount double, "
    "fuel_type string, odometer_km double",
    "fact_maintenance": "maintenance_key bigint, work_order_id string, vehicle_id string, issue string, "
    "opened_at timestamp, closed_at timestamp, priority string, cost double, downtime_hours double",
    "fact_gps": "gps_key bigint, vehicle_id string, timestamp timestamp, latitude double, longitude double, "
    "speed double",
    "fact_vehicle_telemetry": "telemetry_key bigint, vehicle_id string, timestamp timestamp, engine_status string, "
    "fuel_level_percent double, remaining_fuel_liters double, odometer_km double",
}

TABLES = tuple(TABLE_COLUMNS)

# Business keys that must be present and unique at load. A repeated date is ignored, any other repeat stops the load.
BUSINESS_KEYS = {
    "dim_depot": "depot_id",
    "dim_vehicle": "vehicle_id",
    "dim_driver": "driver_id",
    "dim_route": "route_id",
    "dim_customer": "customer_id",
    "dim_date": "date",
    "fact_delivery": "order_id",
    "fact_maintenance": "work_order_id",
}

# The event time by which a fact is laid out on disk.
EVENT_TIMES = {
    "fact_trip": "timestamp",
    "fact_delivery": "promised_time",
    "fact_fuel": "timestamp",
    "fact_maintenance": "opened_at",
    "fact_gps": "timestamp",
    "fact_vehicle_telemetry": "timestamp",
}

# Topic names.
GPS_TOPIC = "gps-events"
DELIVERY_TOPIC = "delivery-events"
VEHICLE_TOPIC = "vehicle-events"
TOPICS = (GPS_TOPIC, DELIVERY_TOPIC, VEHICLE_TOPIC)

SILVER_GPS = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("speed", T.DoubleType(), False),
    ]
)


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_COLUMNS[table])


# Declared column types of other stores. The first row with a fragment found in the declared type wins,
# so DATETIME becomes a date.
DECLARED_TYPES = (
    (("INT",), T.LongType()),
    (("CHAR", "CLOB", "TEXT"), T.StringType()),
    (("REAL", "FLOA", "DOUB"), T.DoubleType()),
    (("DECIMAL", "NUMERIC"), T.DecimalType(38, 18)),
    (("BOOL",), T.BooleanType()),
    (("DATE",), T.DateType()),
    (("TIME",), T.TimestampType()),
    (("BLOB",), T.BinaryType()),
)


def type_for_declared(declared: str | None) -> T.DataType:
    """Spark type for a column type declared in another store; text where nothing fits."""
    name = (declared or "").upper()
    return next((spark_type for parts, spark_type in DECLARED_TYPES if any(p in name for p in parts)), T.StringType())
