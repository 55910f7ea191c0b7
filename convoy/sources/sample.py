"""The sample tables (orders, line items, events and so on) seen as fleet tables and fleet events.

Customers stand for vehicles, suppliers for routes, parts for drivers and nations for depots; line items are scans,
refuelling and work orders; events are positions and telemetry. Columns without a source are plain arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions.temporal import date_parts, hours_between
from convoy.operators.lookup import attach_last_scan
from convoy.schemas import DELIVERY_TOPIC, GPS_TOPIC, TABLES, VEHICLE_TOPIC


def _time(name: str) -> Column:
    return F.col(name).cast("timestamp")


class SampleFleet(Mapping[str, DataFrame]):
    """The 12 warehouse tables by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getitem__(self, table: str) -> DataFrame:
        if table not in TABLES:
            raise KeyError(table)
        return getattr(self, table)

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.source("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.source("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.source("events").withColumn("_k", F.get_json_object("props", "$.k").cast("double"))

    @cached_property
    def ordered_lines(self) -> DataFrame:
        return self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def dim_depot(self) -> DataFrame:
        return (
            self.source("nation")
            .join(self.source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").cast("bigint").alias("depot_key"),
                F.col("n_nationkey").alias("depot_id"),
                F.col("n_name").alias("depot_name"),
                F.col("r_name").alias("city"),
                (F.col("n_regionkey") * 100).cast("bigint").alias("capacity"),
            )
        )

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return self.source("customer").select(
            F.col("c_custkey").alias("vehicle_key"),
            F.col("c_custkey").alias("vehicle_id"),
            F.col("c_mktsegment").alias("type"),
            F.col("c_nationkey").alias("depot_id"),
            F.col("c_acctbal").alias("capacity"),
            F.col("c_name").alias("model"),
            F.lit(60.0).alias("fuel_capacity_liters"),
        )

    @cached_property
    def dim_driver(self) -> DataFrame:
        return self.source("part").select(
            F.col("p_partkey").alias("driver_key"),
            F.col("p_partkey").alias("driver_id"),
            F.col("p_name").alias("name"),
            F.pmod("p_partkey", F.lit(25)).alias("depot_id"),
            F.col("p_size").alias("experience_years"),
            F.col("p_brand").alias("shift"),
        )

    @cached_property
    def dim_route(self) -> DataFrame:
        return self.source("supplier").select(
            F.col("s_suppkey").alias("route_key"),
            F.col("s_suppkey").alias("route_id"),
            F.col("s_nationkey").alias("origin"),
            F.col("s_name").alias("destination"),
            F.col("s_acctbal").alias("distance_km"),
            (F.col("s_acctbal") * 1.5).alias("expected_duration_min"),
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.source("customer").select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").alias("city"),
            F.col("c_mktsegment").alias("service_area"),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        day = F.col("_day")
        days = self.orders.select(F.to_date("o_orderdate").alias("_day")).where(day.isNotNull()).distinct()
        return days.select(*[value.alias(name) for name, value in date_parts(day).items()])

    @cached_property
    def scans(self) -> DataFrame:
        """Scans with route and driver, which the sample's orders do not carry themselves."""
        status = F.when(F.col("l_returnflag") == "A", "delivered").when(F.col("l_returnflag") == "R", "delayed")
        return self.lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            _time("l_shipdate").alias("scan_time"),
            F.col("l_linenumber").alias("_line"),
            F.col("l_suppkey").alias("route_id"),
            F.col("l_partkey").alias("driver_id"),
            F.col("l_extendedprice").alias("_price"),
            status.otherwise("in_transit").alias("scan_status"),
            F.col("l_linestatus").alias("location"),
        )

    @cached_property
    def fact_delivery(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "Delivered").when(F.col("o_orderstatus") == "P", "Delayed")
        orders = self.orders.select(
            F.col("o_orderkey").alias("delivery_key"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_custkey").alias("vehicle_id"),
            _time("o_orderdate").alias("promised_time"),
            status.otherwise("in_transit").alias("status"),
        )
        tiebreak = ["_line", "route_id", "driver_id", "_price", "scan_status", "location"]
        return attach_last_scan(orders, self.scans, tiebreak).drop("_line", "_price")

    @cached_property
    def fact_fuel(self) -> DataFrame:
        return self.ordered_lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("fuel_key"),
            F.col("o_custkey").alias("vehicle_id"),
            _time("l_shipdate").alias("timestamp"),
            F.col("l_quantity").alias("liters"),
            F.col("l_extendedprice").alias("amount"),
            F.col("l_returnflag").alias("fuel_type"),
            F.col("l_partkey").cast("double").alias("odometer_km"),
        )

    @cached_property
    def fact_maintenance(self) -> DataFrame:
        key = F.concat_ws("-", "l_orderkey", "l_linenumber")
        return self.ordered_lines.select(
            key.alias("maintenance_key"),
            key.alias("work_order_id"),
            F.col("o_custkey").alias("vehicle_id"),
            F.col("l_linestatus").alias("issue"),
            _time("o_orderdate").alias("opened_at"),
            _time("l_shipdate").alias("closed_at"),
            F.substring("o_orderpriority", 3, 100).alias("priority"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("cost"),
            hours_between(_time("o_orderdate"), _time("l_shipdate")).alias("downtime_hours"),
        )

    @cached_property
    def fact_gps(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("gps_key"),
            F.col("user_id").alias("vehicle_id"),
            _time("ts").alias("timestamp"),
            F.col("_k").alias("latitude"),
            F.col("value").alias("longitude"),
            F.col("value").alias("speed"),
        )

    @cached_property
    def fact_trip(self) -> DataFrame:
        return self.fact_gps.withColumnRenamed("gps_key", "trip_key")

    @cached_property
    def fact_vehicle_telemetry(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("telemetry_key"),
            F.col("user_id").alias("vehicle_id"),
            _time("ts").alias("timestamp"),
            F.when(F.col("event_type").isin("click", "view"), "ON").otherwise("OFF").alias("engine_status"),
            F.col("_k").alias("fuel_level_percent"),
            (F.col("_k") * 0.6).alias("remaining_fuel_liters"),
            F.col("value").alias("odometer_km"),
        )

    @cached_property
    def trips_for_training(self) -> DataFrame:
        """Features and a noisy linear label from line items; the sample holds no fuel signal of its own."""
        distance = F.col("l_quantity") * 10
        speed = F.lit(20) + F.col("l_discount") * 800
        noise = F.pmod(F.hash("l_orderkey"), F.lit(5)) - 2
        return self.lineitem.select(
            "l_orderkey",
            "l_linenumber",
            distance.alias("distance_km"),
            speed.alias("speed_kmh"),
            (F.lit(10.0) + F.pmod("l_partkey", F.lit(91))).alias("fuel_level"),
            (F.lit(0.08) * distance + F.lit(0.03) * speed + noise).alias("fuel_consumption"),
        )

    @property
    def lost_lines(self) -> DataFrame:
        """Bronze lines of no known topic, one of three kinds for every nation: cut off, without a topic, of another topic."""
        number = F.col("n_nationkey").cast("string")
        kinds = (
            F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('{"kafka_topic":"gps-events","offset":'), number))
            .when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit('{"partition":0,"offset":'), number, F.lit(',"event":{"a":1}}')))
            .otherwise(F.concat(F.lit('{"kafka_topic":"other","offset":'), number, F.lit(',"event":{"a":1}}')))
        )
        return self.source("nation").select(kinds.alias("value"))

    def gps_messages(self, events: DataFrame | None = None) -> DataFrame:
        """Events as messages of the position topic.

        Purchases are sent twice, with the copy in another partition. Errors are cut off in the middle of the text.
        Signups have their speed as text. Latitudes above 90 and longitudes above 180 come from the data.
        """
        rows = self.events if events is None else events
        kind = F.col("event_type")
        speed_text = F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))
        body = F.concat(
            F.lit('{"vehicle_id":"V'),
            F.col("user_id").cast("string"),
            F.lit('","timestamp":"'),
            F.date_format(_time("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            F.lit('+00:00","latitude":'),
            F.col("_k").cast("string"),
            F.lit(',"longitude":'),
            F.col("value").cast("string"),
            F.lit(',"speed":'),
            F.when(kind == "signup", speed_text).otherwise(F.col("value").cast("string")),
            F.lit(',"kind":"'),
            kind,
            F.when(kind == "error", "").otherwise('"}'),
        )
        copies = F.when(kind == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return rows.select(
            F.lit(GPS_TOPIC).alias("topic"),
            F.explode(copies).alias("partition"),
            F.col("event_id").alias("offset"),
            body.alias("value"),
        )

    @cached_property
    def delivery_messages(self) -> DataFrame:
        """Orders as messages of the delivery topic. Orders with status P carry a status nobody knows."""
        status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "in_transit")
        event = F.struct(
            F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
            F.concat(F.lit("V"), F.col("o_custkey").cast("string")).alias("vehicle_id"),
            F.date_format(_time("o_orderdate"), "yyyy-MM-dd").alias("timestamp"),
            status.otherwise("lost").alias("status"),
            F.col("o_orderpriority").alias("location"),
        )
        return self.orders.select(
            F.lit(DELIVERY_TOPIC).alias("topic"),
            F.lit(0).alias("partition"),
            F.col("o_orderkey").alias("offset"),
            F.to_json(event).alias("value"),
        )

    @cached_property
    def vehicle_messages(self) -> DataFrame:
        """Events as messages of the vehicle topic. Signups lack the fuel level; values above 100 are out of range."""
        status = F.when(F.col("event_type").isin("click", "view"), "ON").otherwise("OFF")
        event = F.struct(
            F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
            F.date_format(_time("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            status.alias("engine_status"),
            F.when(F.col("event_type") != "signup", F.col("value")).alias("fuel_level"),
        )
        return self.events.select(
            F.lit(VEHICLE_TOPIC).alias("topic"),
            F.lit(0).alias("partition"),
            F.col("event_id").alias("offset"),
            F.to_json(event).alias("value"),
        )

    def stream_events(self) -> DataFrame:
        """The sample events as a stream. The path is a pattern, since a stream takes a plain path for a folder."""
        return (
            self.spark.readStream.schema(self.source("events").schema)
            .parquet(f"{self.sf_dir}/[e]vents.parquet")
            .withColumn("_k", F.get_json_object("props", "$.k").cast("double"))
        )
