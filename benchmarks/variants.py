"""Time our plans against the literal forms they replace, and against SQLite on the same tables.

Reads the sample tables named by BENCH_SF_DIR, writes them once as fleet tables into a new folder, and prints one JSON
line of medians. SQLite runs in this process, in memory, with an index on every join key, which a fleet database of this
size would have; its load time is not counted.
"""

from __future__ import annotations

import json
import os
import sqlite3
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from convoy.functions.numeric import exact_sum, mean2, round2  # noqa: E402
from convoy.operators import kpi, latest, quality, serving  # noqa: E402
from convoy.session import build_session, work_dir  # noqa: E402
from convoy.sources.sample import SampleFleet  # noqa: E402
from convoy.sources.tables import copy_tables, read_table  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "5"))
FLEET = ("dim_vehicle", "fact_delivery", "fact_gps", "fact_fuel", "fact_maintenance")
HEADLINE = ("dim_vehicle", "dim_driver", "dim_route", "fact_delivery", "fact_fuel", "fact_maintenance")


def fanned_vehicle_kpi(t):
    """All facts of a vehicle joined with each other before they are counted."""
    joined = (
        t["dim_vehicle"]
        .select("vehicle_id", "type", "model", "depot_id", "capacity")
        .join(t["fact_delivery"].select("vehicle_id", "order_id"), "vehicle_id", "left")
        .join(t["fact_gps"].select("vehicle_id", "timestamp", "speed"), "vehicle_id", "left")
        .join(kpi.fuel_efficiency(t["fact_fuel"]).select("vehicle_id", "km_per_liter"), "vehicle_id", "left")
        .join(
            kpi.cost_per_delivery(t["dim_vehicle"], t["fact_fuel"], t["fact_delivery"]).select(
                "vehicle_id", "cost_per_delivery"
            ),
            "vehicle_id",
            "left",
        )
        .join(kpi.maintenance_kpi(t["fact_maintenance"]).select("vehicle_id", "downtime_hours"), "vehicle_id", "left")
    )
    keys = "vehicle_id type model depot_id capacity km_per_liter cost_per_delivery downtime_hours".split()
    return joined.groupBy(*keys).agg(
        F.count_distinct("order_id").alias("deliveries"),
        F.count_distinct("timestamp").alias("gps_events"),
        mean2(exact_sum("speed"), F.count("speed")).alias("average_speed"),
        round2(F.max("speed")).alias("maximum_speed"),
    )


def separate_executive_kpis(t):
    """One scan per figure."""
    fuel, deliveries, maintenance = t["fact_fuel"], t["fact_delivery"], t["fact_maintenance"]
    one = F.count(F.lit(1))
    return kpi.merge_rows(
        t["dim_vehicle"].agg(one.alias("a")),
        t["dim_driver"].agg(one.alias("b")),
        t["dim_route"].agg(one.alias("c")),
        deliveries.agg(one.alias("d")),
        deliveries.agg(F.count_if(F.lower("status") == "delivered").alias("e")),
        fuel.agg(exact_sum("liters").alias("f")),
        fuel.agg(exact_sum("amount").alias("g")),
        fuel.agg((F.max("odometer_km") - F.min("odometer_km")).alias("h"), exact_sum("liters").alias("h2")),
        fuel.agg(exact_sum("amount").alias("i")),
        deliveries.agg(one.alias("j")),
        maintenance.agg(exact_sum("downtime_hours").alias("k")),
        maintenance.agg(one.alias("l")),
    )


def separate_row_checks(t):
    """One query per check."""
    frames = []
    for table, checks in quality._row_counters(("volume", "completeness", "range")).items():
        for family, name, counter in checks:
            frames.append(t[table].agg(counter.alias("value")).select(F.lit(f"{family} {name}").alias("check"), "value"))
    return quality._union(frames)


def correlated_latest(t):
    t["fact_gps"].createOrReplaceTempView("gps")
    return t["fact_gps"].sparkSession.sql(
        "SELECT * FROM gps g WHERE timestamp = (SELECT max(timestamp) FROM gps n WHERE n.vehicle_id = g.vehicle_id)"
    )


SPARK = {
    "vehicle_kpi": lambda t: kpi.vehicle_kpi(*(t[n] for n in FLEET)),
    "vehicle_kpi, facts joined first": fanned_vehicle_kpi,
    "executive_kpis": lambda t: kpi.executive_kpis(*(t[n] for n in HEADLINE)),
    "executive_kpis, one scan per figure": separate_executive_kpis,
    "row_checks": quality.row_checks,
    "row_checks, one query per check": separate_row_checks,
    "latest_position_ties": lambda t: latest.latest_ties(t["fact_gps"]),
    "latest_position_ties, correlated maximum": correlated_latest,
    "fuel_efficiency": lambda t: kpi.fuel_efficiency(t["fact_fuel"]),
    "maintenance_kpi": lambda t: kpi.maintenance_kpi(t["fact_maintenance"]),
    "delivery_trend": lambda t: kpi.delivery_trend(t["fact_delivery"]),
    "depot_performance": lambda t: kpi.depot_performance(*(t[n] for n in FLEET)),
    "fuel_by_type": lambda t: serving.fuel_by_type(t["fact_fuel"]),
}

EFFICIENCY = """SELECT vehicle_id, round(sum(liters), 2) fuel_liters, max(odometer_km) - min(odometer_km) distance_km,
    round((max(odometer_km) - min(odometer_km)) / nullif(sum(liters), 0), 2) km_per_liter, round(sum(amount), 2) fuel_cost,
    count(*) fuel_events FROM fact_fuel GROUP BY vehicle_id"""
COST = """SELECT v.vehicle_id, round(f.paid / nullif(d.made, 0), 2) cost FROM dim_vehicle v
    LEFT JOIN (SELECT vehicle_id, sum(amount) paid FROM fact_fuel GROUP BY vehicle_id) f ON f.vehicle_id = v.vehicle_id
    LEFT JOIN (SELECT vehicle_id, count(*) made FROM fact_delivery GROUP BY vehicle_id) d ON d.vehicle_id = v.vehicle_id"""
UPKEEP = """SELECT vehicle_id, count(*) work_orders, round(sum(downtime_hours), 2) hours, round(avg(downtime_hours), 2) mean_hours,
    round(sum(cost), 2) cost, count(*) FILTER (WHERE lower(priority) = 'high') high FROM fact_maintenance GROUP BY vehicle_id"""
BY_DEPOT = "FROM dim_vehicle v LEFT JOIN {} f ON f.vehicle_id = v.vehicle_id GROUP BY v.depot_id"
SQLITE = {
    "fuel_efficiency": EFFICIENCY,
    "maintenance_kpi": UPKEEP,
    "delivery_trend": """SELECT substr(promised_time, 1, 10) day, count(*) n,
        count(*) FILTER (WHERE lower(status) = 'delivered') delivered,
        count(*) FILTER (WHERE lower(status) = 'delayed') delayed FROM fact_delivery GROUP BY day""",
    "fuel_by_type": "SELECT fuel_type, round(sum(liters), 2), round(sum(amount), 2) FROM fact_fuel GROUP BY fuel_type",
    "vehicle_kpi": f"""SELECT v.vehicle_id, v.type, v.model, v.depot_id, v.capacity, count(DISTINCT d.order_id),
        count(DISTINCT g.timestamp), round(avg(g.speed), 2), round(max(g.speed), 2), e.km_per_liter, c.cost, u.hours
        FROM dim_vehicle v LEFT JOIN fact_delivery d ON d.vehicle_id = v.vehicle_id
        LEFT JOIN fact_gps g ON g.vehicle_id = v.vehicle_id LEFT JOIN ({EFFICIENCY}) e ON e.vehicle_id = v.vehicle_id
        LEFT JOIN ({COST}) c ON c.vehicle_id = v.vehicle_id LEFT JOIN ({UPKEEP}) u ON u.vehicle_id = v.vehicle_id
        GROUP BY v.vehicle_id, v.type, v.model, v.depot_id, v.capacity, e.km_per_liter, c.cost, u.hours""",
    "depot_performance": f"""SELECT n.depot_id, n.vehicles, d.made, g.speed, f.paid, m.hours
        FROM (SELECT depot_id, count(DISTINCT vehicle_id) vehicles FROM dim_vehicle GROUP BY depot_id) n
        LEFT JOIN (SELECT v.depot_id, count(DISTINCT order_id) made {BY_DEPOT.format('fact_delivery')}) d USING (depot_id)
        LEFT JOIN (SELECT v.depot_id, round(avg(speed), 2) speed {BY_DEPOT.format('fact_gps')}) g USING (depot_id)
        LEFT JOIN (SELECT v.depot_id, round(sum(amount), 2) paid {BY_DEPOT.format('fact_fuel')}) f USING (depot_id)
        LEFT JOIN (SELECT v.depot_id, round(sum(downtime_hours), 2) hours {BY_DEPOT.format('fact_maintenance')}) m
            USING (depot_id)""",
    "latest_position_ties": """SELECT * FROM fact_gps g
        WHERE timestamp = (SELECT max(n.timestamp) FROM fact_gps n WHERE n.vehicle_id = g.vehicle_id)""",
}


def median_time(run) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def sqlite_tables(root: str) -> sqlite3.Connection:
    import duckdb

    con = sqlite3.connect(":memory:")
    for table in FLEET:
        cursor = duckdb.connect().execute(f"SELECT * FROM '{root}/{table}/*.parquet'")
        names = [d[0] for d in cursor.description]
        con.execute(f"CREATE TABLE {table} ({', '.join(names)})")
        marks = ", ".join("?" * len(names))
        while rows := cursor.fetchmany(50_000):
            plain = [tuple(str(v) if hasattr(v, "isoformat") else v for v in row) for row in rows]
            con.executemany(f"INSERT INTO {table} VALUES ({marks})", plain)
        time_column = ", timestamp" if "timestamp" in names else ""
        con.execute(f"CREATE INDEX {table}_vehicle ON {table}(vehicle_id{time_column})")
    return con


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("convoy-variants", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    root = work_dir(spark, "variants")
    fleet = SampleFleet(spark, sf_dir)
    copy_tables(spark, fleet, root)
    tables = {name: read_table(spark, root, name) for name in fleet}
    ours = {n: median_time(lambda b=b: b(tables).write.format("noop").mode("overwrite").save()) for n, b in SPARK.items()}
    spark.stop()
    con = sqlite_tables(root)
    theirs = {n: median_time(lambda q=q: con.execute(q).fetchall()) for n, q in SQLITE.items()}
    print(json.dumps({"sf": os.path.basename(sf_dir), "spark": ours, "sqlite": theirs}))


if __name__ == "__main__":
    main()
