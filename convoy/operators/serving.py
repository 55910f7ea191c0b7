"""Figures and lists for the fleet dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.numeric import exact_sum, percent, ratio, round2, sum2
from convoy.functions.predicates import OVERSPEED_ABOVE, motion_status, overspeed, same_word
from convoy.operators.kpi import merge_rows
from convoy.operators.latest import latest_row

ALERT_LIST = 10


def _rows() -> Column:
    return F.count(F.lit(1))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def dashboard_summary(
    vehicles: DataFrame,
    drivers: DataFrame,
    routes: DataFrame,
    deliveries: DataFrame,
    fuel: DataFrame,
    maintenance: DataFrame,
) -> DataFrame:
    """One row of headline figures. On time means scanned no later than promised, out of the delivered ones."""
    done = same_word("status", "delivered")
    merged = merge_rows(
        vehicles.agg(_rows().alias("vehicles")),
        drivers.agg(_rows().alias("drivers")),
        routes.agg(_rows().alias("routes")),
        deliveries.agg(
            _rows().alias("deliveries"),
            F.count_if(done).alias("_done"),
            F.count_if(done & (F.col("scan_time") <= F.col("promised_time"))).alias("_on_time"),
        ),
        fuel.agg(exact_sum("liters").alias("_liters"), exact_sum("amount").alias("_amount")),
        maintenance.agg(exact_sum("downtime_hours").alias("_hours"), _rows().alias("maintenance_work_orders")),
    )
    return merged.select(
        "vehicles",
        "drivers",
        "routes",
        "deliveries",
        _or_zero(percent(F.col("_on_time"), F.col("_done"))).alias("on_time_delivery_rate_percent"),
        _or_zero(round2(F.col("_liters"))).alias("fuel_liters"),
        _or_zero(round2(F.col("_amount"))).alias("fuel_cost"),
        _or_zero(round2(ratio(F.col("_amount"), F.col("deliveries")))).alias("fuel_cost_per_delivery"),
        _or_zero(round2(F.col("_hours"))).alias("maintenance_downtime_hours"),
        "maintenance_work_orders",
    )


def delivery_performance(deliveries: DataFrame) -> DataFrame:
    """Delivered against delayed by the last scan, matched with exact case."""
    counted = deliveries.agg(
        F.count_if(F.col("scan_status") == "delivered").alias("delivered"),
        F.count_if(F.col("scan_status") == "delayed").alias("delayed"),
    )
    completed = F.col("delivered") + F.col("delayed")
    return counted.select(
        completed.alias("total_deliveries"),
        "delivered",
        "delayed",
        _or_zero(percent(F.col("delivered"), completed)).alias("on_time_rate_percent"),
    )


def fuel_by_type(fuel: DataFrame) -> DataFrame:
    return (
        fuel.groupBy("fuel_type")
        .agg(sum2("liters").alias("total_liters"), sum2("amount").alias("total_cost"))
        .orderBy(F.col("total_cost").desc(), "fuel_type")
    )


def maintenance_by_priority(maintenance: DataFrame) -> DataFrame:
    return (
        maintenance.groupBy("priority")
        .agg(
            _rows().alias("work_orders"),
            sum2("cost").alias("total_cost"),
            sum2("downtime_hours").alias("total_downtime_hours"),
        )
        .orderBy(F.col("total_cost").desc(), "priority")
    )


def fleet_status(gps: DataFrame, tiebreak: str = "gps_key") -> DataFrame:
    """Moving, idle and stopped vehicles by their newest position."""
    newest = latest_row(gps.select("vehicle_id", "timestamp", tiebreak, "speed"), [F.col(tiebreak).desc()])
    return _status_counts(newest)


def _status_counts(positions: DataFrame) -> DataFrame:
    status = motion_status("speed")
    return positions.agg(
        F.count_if(status == "Moving").alias("moving"),
        F.count_if(status == "Idle").alias("idle"),
        F.count_if(status == "Stopped").alias("stopped"),
        _rows().alias("total"),
    )


def filter_fleet(
    live: DataFrame, vehicle_id: str | None = None, status: str | None = None
) -> DataFrame:
    """Live fleet with its motion status, narrowed to one vehicle or status where given."""
    chosen = live if vehicle_id is None else live.where(F.col("vehicle_id") == vehicle_id)
    shown = chosen.withColumn("status", motion_status("speed"))
    return shown if status is None else shown.where(F.col("status") == status)


def filter_routes(routes: DataFrame, route_id: str | None = None) -> DataFrame:
    return routes if route_id is None else routes.where(F.col("route_id") == route_id)


def shown_first(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of a list in its display order."""
    return df.orderBy(*order).limit(n)


def overspeed_alerts(
    gps: DataFrame, tiebreak: list[Column], limit: float = OVERSPEED_ABOVE, n: int = ALERT_LIST
) -> DataFrame:
    """The fastest readings above the speed limit."""
    return (
        gps.where(overspeed("speed", limit))
        .orderBy(F.col("speed").desc(), *tiebreak)
        .limit(n)
        .select("vehicle_id", "speed", F.round("speed", 1).alias("shown_speed"), "timestamp")
    )


def alert_counters(
    silver_gps: DataFrame,
    gps: DataFrame,
    deliveries: DataFrame,
    tiebreak: str = "gps_key",
    limit: float = OVERSPEED_ABOVE,
    n: int = ALERT_LIST,
) -> DataFrame:
    """One row of alert counts. ``overspeed`` is the length of the alert list, ``overspeed_total`` counts all of them."""
    fast = F.count_if(overspeed("speed", limit))
    return merge_rows(
        silver_gps.agg(F.least(fast, F.lit(n)).alias("overspeed"), fast.alias("overspeed_total")),
        fleet_status(gps, tiebreak).select("stopped", "idle"),
        deliveries.agg(F.count_if(F.col("scan_status") == "delayed").alias("delayed")),
    )


def bounding_box(positions: DataFrame) -> DataFrame:
    """South-west and north-east corner of the given positions."""
    placed = positions.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return placed.agg(
        F.min("latitude").alias("south"),
        F.max("latitude").alias("north"),
        F.min("longitude").alias("west"),
        F.max("longitude").alias("east"),
    )
