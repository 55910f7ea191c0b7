"""Raw CSV files to the 12 warehouse tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions.temporal import date_parts, hours_between, iso_timestamp
from convoy.operators.lookup import attach_last_scan
from convoy.schemas import BUSINESS_KEYS, TABLES
from convoy.sources.csv import LOADS, OPEN_QUOTE, column_of, faults, kinds_of, load_csv, read_csv, read_refused, typed, with_key
from convoy.sources.tables import View, rebuild_tables

ORDER_COLUMNS = ("order_id", "customer_id", "route_id", "vehicle_id", "driver_id", "promised_time", "status")

# Files that fill no table by themselves or with changes, and their columns that are not text.
OTHER_FILES = {
    "orders.csv": {"promised_time": "timestamp"},
    "delivery_scans.csv": {"scan_time": "timestamp"},
    "maintenance.csv": {"opened_at": "timestamp", "closed_at": "timestamp", "cost": "double"},
}
#: Tables of the warehouse that tell what its build left out or could not read.
REFUSED, FAULTS = "load_refused", "load_faults"


def read_orders(spark: SparkSession, raw_dir: str, strict: bool = False) -> DataFrame:
    raw = read_csv(spark, f"{raw_dir}/orders.csv", strict=strict)
    columns = [column_of(raw, c).alias(c) for c in ORDER_COLUMNS]
    return raw.select(*columns).withColumn("promised_time", iso_timestamp(F.col("promised_time")))


def read_scans(spark: SparkSession, raw_dir: str, strict: bool = False) -> DataFrame:
    raw = read_csv(spark, f"{raw_dir}/delivery_scans.csv", strict=strict)
    return raw.select(
        column_of(raw, "order_id").alias("order_id"),
        iso_timestamp(column_of(raw, "scan_time")).alias("scan_time"),
        column_of(raw, "status").alias("scan_status"),
        column_of(raw, "location").alias("location"),
    )


def date_dimension(orders: DataFrame) -> DataFrame:
    """One row per promised day."""
    day = F.col("_day")
    days = orders.select(F.to_date("promised_time").alias("_day")).where(day.isNotNull()).distinct()
    return days.select(*[value.alias(name) for name, value in date_parts(day).items()])


def read_maintenance(spark: SparkSession, raw_dir: str, strict: bool = False) -> DataFrame:
    raw = read_csv(spark, f"{raw_dir}/maintenance.csv", strict=strict)
    texts = [column_of(raw, c).alias(c) for c in ("work_order_id", "vehicle_id", "issue")]
    rows = raw.select(
        *texts,
        iso_timestamp(column_of(raw, "opened_at")).alias("opened_at"),
        iso_timestamp(column_of(raw, "closed_at")).alias("closed_at"),
        column_of(raw, "priority").alias("priority"),
        typed(column_of(raw, "cost"), "double").alias("cost"),
    )
    timed = rows.withColumn("downtime_hours", hours_between(F.col("opened_at"), F.col("closed_at")))
    return with_key(timed, "maintenance_key")


def trips_from_gps(gps: DataFrame) -> DataFrame:
    """Trips are the positions under another key."""
    return gps.withColumnRenamed("gps_key", "trip_key")


def raw_tables(spark: SparkSession, raw_dir: str, strict: Collection[str] = ()) -> dict[str, DataFrame]:
    """All tables, read from the raw files when used. Of the files named by ``strict`` short lines are refused too."""
    tables = {load.table: load_csv(spark, raw_dir, load, load.file in strict) for load in LOADS}
    orders = read_orders(spark, raw_dir, "orders.csv" in strict)
    scans = read_scans(spark, raw_dir, "delivery_scans.csv" in strict)
    tables["dim_date"] = date_dimension(orders)
    tables["fact_delivery"] = attach_last_scan(with_key(orders, "delivery_key"), scans)
    tables["fact_maintenance"] = read_maintenance(spark, raw_dir, "maintenance.csv" in strict)
    tables["fact_trip"] = trips_from_gps(tables["fact_gps"])
    return {name: tables[name] for name in TABLES}


def load_faults(spark: SparkSession, raw_dir: str) -> DataFrame:
    """What is wrong with the raw files, as (file, fault, rows), one pass over each; zero counts are listed too."""
    found = [(load.file, kinds_of(load), load.line_breaks) for load in LOADS]
    found += [(file, kinds, False) for file, kinds in OTHER_FILES.items()]
    parts = [
        faults(spark, f"{raw_dir}/{file}", kinds, breaks).select(F.lit(file).alias("file"), "fault", "rows")
        for file, kinds, breaks in found
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def refused_lines(spark: SparkSession, raw_dir: str, strict: Collection[str] = ()) -> DataFrame:
    """The lines of the raw files that are in no table, as (file, line, fault)."""
    union = None
    for file in [*(load.file for load in LOADS if not load.line_breaks), *OTHER_FILES]:
        part = read_refused(spark, f"{raw_dir}/{file}", file in strict).select(F.lit(file).alias("file"), "line", "fault")
        union = part if union is None else union.unionByName(part)
    return union


def build_warehouse(spark: SparkSession, raw_dir: str, root: str) -> dict[str, int]:
    """Rebuild the warehouse below root and return the rows per table.

    Trips are stored as a view of the positions. Beside the tables lie ``load_faults``, the counts of what was refused or
    could not be read, and ``load_refused``, the lines themselves.
    """
    found = load_faults(spark, raw_dir).collect()
    strict = {row["file"] for row in found if row["fault"] == OPEN_QUOTE and row["rows"]}
    tables = {**raw_tables(spark, raw_dir, strict), "fact_trip": View("fact_gps", {"gps_key": "trip_key"})}
    tables[REFUSED] = refused_lines(spark, raw_dir, strict)
    tables[FAULTS] = spark.createDataFrame(found, "file string, fault string, rows long")
    counts = rebuild_tables(spark, tables, root, BUSINESS_KEYS)
    return {name: counts[name] for name in TABLES}
