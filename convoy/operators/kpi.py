"""Governed KPIs.

Every fact is reduced to its group key before it meets another table. The joins are then one row to one row, whatever
the number of facts behind a vehicle or route.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.numeric import exact_sum, mean2, percent, ratio, round2, sum2
from convoy.functions.predicates import same_word
from convoy.functions.temporal import date_text

# Limits of the exception rules.
DELAY_RATE_FROM = 20.0
KM_PER_LITER_BELOW = 8.0
DOWNTIME_FROM = 24.0


def _rows() -> Column:
    return F.count(F.lit(1))


def _delivered() -> Column:
    return F.count_if(same_word("status", "delivered"))


def _delayed() -> Column:
    return F.count_if(same_word("status", "delayed"))


def merge_rows(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side, without a cross join."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first.agg(*[F.max(c).alias(c) for c in first.columns])


def delivery_trend(deliveries: DataFrame) -> DataFrame:
    """Deliveries per promised day. On time means status delivered, out of all deliveries."""
    return (
        deliveries.groupBy(F.to_date("promised_time").alias("_day"))
        .agg(_rows().alias("total_deliveries"), _delivered().alias("delivered"), _delayed().alias("delayed"))
        .select(
            date_text(F.col("_day")).alias("date"),
            "total_deliveries",
            "delivered",
            "delayed",
            percent(F.col("delivered"), F.col("total_deliveries")).alias("on_time_rate"),
            percent(F.col("delayed"), F.col("total_deliveries")).alias("delay_rate"),
        )
    )


def _fuel_totals(fuel: DataFrame, *keys: str) -> DataFrame:
    return fuel.groupBy(*keys).agg(
        exact_sum("liters").alias("_liters"),
        (F.max("odometer_km") - F.min("odometer_km")).alias("_km"),
        exact_sum("amount").alias("_amount"),
        _rows().alias("fuel_events"),
    )


def _km_per_liter() -> Column:
    return round2(ratio(F.col("_km"), F.col("_liters")))


def fuel_efficiency(fuel: DataFrame) -> DataFrame:
    """Fuel, odometer span and kilometres per liter of every vehicle."""
    return _fuel_totals(fuel, "vehicle_id").select(
        "vehicle_id",
        round2(F.col("_liters")).alias("fuel_liters"),
        round2(F.col("_km")).alias("distance_km"),
        _km_per_liter().alias("km_per_liter"),
        round2(F.col("_amount")).alias("fuel_cost"),
        "fuel_events",
    )


def _cost_per_delivery(amount: str, deliveries: str) -> Column:
    return round2(ratio(F.coalesce(F.col(amount), F.lit(0)), F.coalesce(F.col(deliveries), F.lit(0))))


def cost_per_delivery(vehicles: DataFrame, fuel: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Fuel cost per delivery of every vehicle, NULL for a vehicle without deliveries."""
    spent = fuel.groupBy("vehicle_id").agg(exact_sum("amount").alias("_amount"))
    made = deliveries.groupBy("vehicle_id").agg(_rows().alias("_made"))
    return (
        vehicles.select("vehicle_id")
        .join(spent, "vehicle_id", "left")
        .join(made, "vehicle_id", "left")
        .select(
            "vehicle_id",
            F.coalesce(F.col("_amount").cast("double"), F.lit(0.0)).alias("fuel_cost"),
            F.coalesce("_made", F.lit(0)).alias("deliveries"),
            _cost_per_delivery("_amount", "_made").alias("cost_per_delivery"),
        )
    )


def idle_time(telemetry: DataFrame) -> DataFrame:
    """Engine-on counts of every vehicle. No speed is involved, despite the name the report carries."""
    running = same_word("engine_status", "on")
    return telemetry.groupBy("vehicle_id").agg(
        _rows().alias("telemetry_events"),
        F.count_if(running & (F.col("fuel_level_percent") >= 0)).alias("engine_on_events"),
        F.count_if(running & F.col("odometer_km").isNotNull()).alias("active_engine_events"),
    )


def maintenance_kpi(maintenance: DataFrame) -> DataFrame:
    """Work orders, downtime and cost of every vehicle."""
    return (
        maintenance.groupBy("vehicle_id")
        .agg(
            _rows().alias("work_orders"),
            exact_sum("downtime_hours").alias("_hours"),
            F.count("downtime_hours").alias("_timed"),
            sum2("cost").alias("maintenance_cost"),
            F.count_if(same_word("priority", "high")).alias("high_priority_orders"),
        )
        .select(
            "vehicle_id",
            "work_orders",
            round2(F.col("_hours")).alias("downtime_hours"),
            mean2(F.col("_hours"), F.col("_timed")).alias("average_downtime_hours"),
            "maintenance_cost",
            "high_priority_orders",
        )
    )


def route_performance(routes: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Orders and delay rate of every route; a route without orders has zeros and no rate."""
    by_route = deliveries.groupBy("route_id").agg(
        F.count("order_id").alias("total_orders"),
        _delivered().alias("delivered_orders"),
        _delayed().alias("delayed_orders"),
    )
    counts = ["total_orders", "delivered_orders", "delayed_orders"]
    return (
        routes.select("route_id", "origin", "destination", "distance_km", "expected_duration_min")
        .join(by_route, "route_id", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
        .withColumn("delay_rate", percent(F.col("delayed_orders"), F.col("total_orders")))
    )


def _gps_by_vehicle(gps: DataFrame) -> DataFrame:
    return gps.groupBy("vehicle_id").agg(
        F.count_distinct("timestamp").alias("gps_events"),
        exact_sum("speed").alias("_speed"),
        F.count("speed").alias("_speeds"),
        F.max("speed").alias("_top"),
    )


def vehicle_kpi(
    vehicles: DataFrame, deliveries: DataFrame, gps: DataFrame, fuel: DataFrame, maintenance: DataFrame
) -> DataFrame:
    """Use, speed, efficiency, cost and downtime of every vehicle.

    Joining all facts first and counting distinct values afterwards gives the same figures, but its intermediate result
    is deliveries times positions per vehicle. Here each fact is grouped on its own, then joined one to one.
    """
    made = deliveries.groupBy("vehicle_id").agg(
        F.count_distinct("order_id").alias("deliveries"), _rows().alias("_made")
    )
    down = maintenance.groupBy("vehicle_id").agg(exact_sum("downtime_hours").alias("_hours"))
    frames = [made, _gps_by_vehicle(gps), _fuel_totals(fuel, "vehicle_id"), down]
    joined = vehicles.select("vehicle_id", "type", "model", "depot_id", "capacity")
    for frame in frames:
        joined = joined.join(frame, "vehicle_id", "left")
    zero = F.lit(0.0)
    return joined.select(
        "vehicle_id",
        "type",
        "model",
        "depot_id",
        "capacity",
        F.coalesce("deliveries", F.lit(0)).alias("deliveries"),
        F.coalesce("gps_events", F.lit(0)).alias("gps_events"),
        mean2(F.col("_speed"), F.col("_speeds")).alias("average_speed"),
        round2(F.col("_top")).alias("maximum_speed"),
        F.coalesce(_km_per_liter(), zero).alias("km_per_liter"),
        F.coalesce(_cost_per_delivery("_amount", "_made"), zero).alias("cost_per_delivery"),
        F.coalesce(round2(F.col("_hours")), zero).alias("maintenance_downtime_hours"),
    )


def depot_performance(
    vehicles: DataFrame, deliveries: DataFrame, gps: DataFrame, fuel: DataFrame, maintenance: DataFrame
) -> DataFrame:
    """Figures of every depot that has vehicles.

    Totals and counts are carried up from the vehicle, so the mean speed weighs every position alike. The figures of
    the vehicles without a depot stay 0, since no depot row can be matched to them.
    """
    speed = gps.groupBy("vehicle_id").agg(exact_sum("speed").alias("_speed"), F.count("speed").alias("_speeds"))
    spent = fuel.groupBy("vehicle_id").agg(exact_sum("amount").alias("_amount"))
    down = maintenance.groupBy("vehicle_id").agg(exact_sum("downtime_hours").alias("_hours"))
    fleet = vehicles.select("vehicle_id", "depot_id")
    joined = fleet
    for frame in (speed, spent, down):
        joined = joined.join(frame, "vehicle_id", "left")
    by_depot = joined.groupBy("depot_id").agg(
        F.count_distinct("vehicle_id").alias("vehicles"),
        exact_sum("_speed").alias("_speed"),
        F.sum("_speeds").alias("_speeds"),
        exact_sum("_amount").alias("_amount"),
        exact_sum("_hours").alias("_hours"),
    )
    # an order id occurs once, which every load checks, so the orders of a depot are those of its vehicles
    orders = deliveries.groupBy("vehicle_id").agg(F.count_distinct("order_id").alias("deliveries"))
    made = (
        orders.join(fleet.where(F.col("depot_id").isNotNull()), "vehicle_id")
        .groupBy("depot_id")
        .agg(F.sum("deliveries").alias("deliveries"))
    )

    def or_zero(value: Column) -> Column:
        return F.coalesce(F.when(F.col("depot_id").isNotNull(), value), F.lit(0.0))

    return by_depot.join(made, "depot_id", "left").select(
        "depot_id",
        "vehicles",
        F.coalesce("deliveries", F.lit(0)).alias("deliveries"),
        or_zero(mean2(F.col("_speed"), F.col("_speeds"))).alias("average_speed"),
        or_zero(round2(F.col("_amount"))).alias("fuel_cost"),
        or_zero(round2(F.col("_hours"))).alias("maintenance_downtime"),
    )


def executive_kpis(
    vehicles: DataFrame,
    drivers: DataFrame,
    routes: DataFrame,
    deliveries: DataFrame,
    fuel: DataFrame,
    maintenance: DataFrame,
) -> DataFrame:
    """One row of fleet totals, from one pass over each table.

    Kilometres per liter spans the lowest to the highest odometer of the whole fleet; it is no mean over vehicles.
    """
    merged = merge_rows(
        vehicles.agg(_rows().alias("total_vehicles")),
        drivers.agg(_rows().alias("total_drivers")),
        routes.agg(_rows().alias("total_routes")),
        deliveries.agg(_rows().alias("total_deliveries"), _delivered().alias("_delivered")),
        _fuel_totals(fuel).drop("fuel_events"),
        maintenance.agg(exact_sum("downtime_hours").alias("_hours"), _rows().alias("total_maintenance_work_orders")),
    )
    return merged.select(
        "total_vehicles",
        "total_drivers",
        "total_routes",
        "total_deliveries",
        percent(F.col("_delivered"), F.col("total_deliveries")).alias("on_time_delivery_rate"),
        round2(F.col("_liters")).alias("total_fuel_liters"),
        round2(F.col("_amount")).alias("total_fuel_cost"),
        _km_per_liter().alias("fleet_km_per_liter"),
        ratio(round2(F.col("_amount")), F.col("total_deliveries")).alias("fleet_cost_per_delivery"),
        round2(F.col("_hours")).alias("total_maintenance_downtime_hours"),
        "total_maintenance_work_orders",
    )


def exceptions(
    route_kpi: DataFrame,
    efficiency: DataFrame,
    maintenance: DataFrame,
    delay_rate_from: float = DELAY_RATE_FROM,
    km_per_liter_below: float = KM_PER_LITER_BELOW,
    downtime_from: float = DOWNTIME_FROM,
) -> DataFrame:
    """Rule violations found in the route, fuel and maintenance KPIs."""

    def rule(df: DataFrame, kind: str, entity: str, severity: str, metric: str, text: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("exception_type"),
            F.col(entity).cast("string").alias("entity_id"),
            F.lit(severity).alias("severity"),
            F.col(metric).alias("metric_value"),
            F.lit(text).alias("description"),
        )

    late = route_kpi.where((F.col("total_orders") > 0) & (F.col("delay_rate") >= delay_rate_from))
    thirsty = efficiency.where((F.col("km_per_liter") > 0) & (F.col("km_per_liter") < km_per_liter_below))
    broken = maintenance.where(F.col("downtime_hours") >= downtime_from)
    return (
        rule(late, "DELAYED_ROUTE", "route_id", "HIGH", "delay_rate", "Route has elevated delivery delay rate")
        .unionByName(
            rule(
                thirsty, "LOW_FUEL_EFFICIENCY", "vehicle_id", "MEDIUM", "km_per_liter", "Vehicle has low fuel efficiency"
            )
        )
        .unionByName(
            rule(
                broken,
                "HIGH_MAINTENANCE_DOWNTIME",
                "vehicle_id",
                "HIGH",
                "downtime_hours",
                "Vehicle has high maintenance downtime",
            )
        )
    )
