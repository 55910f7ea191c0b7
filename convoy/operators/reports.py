"""Ranked reports on the KPIs. Each order ends in a key, so equal ranks come out the same way every time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREND_DAYS = 20
TOP = 10
TOP_EXCEPTIONS = 20
RECENT = 100

# Rank of each severity, all others follow.
SEVERITY_RANK = {"HIGH": 1, "MEDIUM": 2}


def first_days(trend: DataFrame, n: int = TREND_DAYS) -> DataFrame:
    return trend.orderBy(F.col("date").asc_nulls_first()).limit(n)


def worst_routes(route_kpi: DataFrame, n: int = TOP) -> DataFrame:
    return (
        route_kpi.where(F.col("total_orders") > 0)
        .select("route_id", "origin", "destination", "total_orders", "delayed_orders", "delay_rate")
        .orderBy(F.col("delay_rate").desc(), "route_id")
        .limit(n)
    )


def busiest_vehicles(vehicle_kpi: DataFrame, n: int = TOP) -> DataFrame:
    return (
        vehicle_kpi.select(
            "vehicle_id",
            "type",
            "model",
            "depot_id",
            "deliveries",
            "average_speed",
            "km_per_liter",
            "cost_per_delivery",
            "maintenance_downtime_hours",
        )
        .orderBy(F.col("deliveries").desc(), "vehicle_id")
        .limit(n)
    )


def depot_ranking(depot_kpi: DataFrame) -> DataFrame:
    return depot_kpi.orderBy(F.col("deliveries").desc(), "depot_id")


def top_exceptions(found: DataFrame, n: int = TOP_EXCEPTIONS) -> DataFrame:
    rank = F.lit(len(SEVERITY_RANK) + 1)
    for severity, place in SEVERITY_RANK.items():
        rank = F.when(F.col("severity") == severity, place).otherwise(rank)
    return found.orderBy(rank, F.col("metric_value").desc(), "exception_type", "entity_id").limit(n)


def most_recent(df: DataFrame, at: str, n: int = RECENT) -> DataFrame:
    """The n newest rows; all other columns decide between equal times."""
    others = [F.col(c).asc_nulls_last() for c in df.columns if c != at]
    return df.orderBy(F.col(at).desc_nulls_last(), *others).limit(n)


def recent_fuel(fuel: DataFrame, n: int = RECENT) -> DataFrame:
    wanted = ["fuel_key", "vehicle_id", "timestamp", "liters", "amount", "fuel_type", "odometer_km"]
    return most_recent(fuel.select(*wanted), "timestamp", n)


def recent_maintenance(maintenance: DataFrame, n: int = RECENT) -> DataFrame:
    wanted = [
        "maintenance_key",
        "work_order_id",
        "vehicle_id",
        "issue",
        "opened_at",
        "closed_at",
        "priority",
        "cost",
        "downtime_hours",
    ]
    return most_recent(maintenance.select(*wanted), "opened_at", n)
