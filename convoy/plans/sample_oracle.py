"""The queries over the sample tables as plain SQL, written independently of the Spark plans."""

from __future__ import annotations

import re

from convoy.schemas import DELIVERY_TOPIC, GPS_TOPIC, TABLES, VEHICLE_TOPIC


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,6))"


def r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,8)), 2) AS DOUBLE)"


def s2(x: str) -> str:
    return r2(f"sum({dec(x)})")


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str) -> str:
    return r2(div(f"100.0 * ({a})", b))


def mean(x: str) -> str:
    return r2(div(f"sum({dec(x)})", f"count({x})"))


def when(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


DONE = "count(*) FILTER (WHERE lower(status) = 'delivered')"
LATE = "count(*) FILTER (WHERE lower(status) = 'delayed')"
STATUS = "CASE WHEN coalesce(speed, 0) > 5 THEN 'Moving' WHEN coalesce(speed, 0) > 0 THEN 'Idle' ELSE 'Stopped' END"
GOOD_GPS = "event_type <> 'error' AND k BETWEEN -90 AND 90 AND value BETWEEN 0 AND 180"
# The known states of a delivery.
STATUSES = "'picked_up', 'in_transit', 'delivered', 'delayed', 'cancelled'"

CTES = {
    "keyed_events": "SELECT *, CAST(props->>'k' AS DOUBLE) AS k FROM events",
    "ordered_lines": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "dim_depot": """SELECT CAST(n_nationkey AS BIGINT) AS depot_key, n_nationkey AS depot_id, n_name AS depot_name,
        r_name AS city, CAST(n_regionkey * 100 AS BIGINT) AS capacity
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_vehicle": """SELECT c_custkey AS vehicle_id, c_mktsegment AS type, c_name AS model, c_nationkey AS depot_id,
        c_acctbal AS capacity FROM customer""",
    "dim_driver": "SELECT p_partkey AS driver_id, p_name AS name FROM part",
    "dim_route": """SELECT s_suppkey AS route_key, s_suppkey AS route_id, s_nationkey AS origin, s_name AS destination,
        s_acctbal AS distance_km, s_acctbal * 1.5 AS expected_duration_min FROM supplier""",
    "dim_customer": "SELECT c_custkey AS customer_id FROM customer",
    "dim_date": """SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
        strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
        CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders""",
    "fact_gps": """SELECT event_id AS gps_key, user_id AS vehicle_id, ts, k AS latitude, value AS longitude,
        value AS speed FROM keyed_events""",
    "fact_trip": "SELECT * FROM fact_gps",
    "fact_vehicle_telemetry": """SELECT user_id AS vehicle_id,
        CASE WHEN event_type IN ('click', 'view') THEN 'ON' ELSE 'OFF' END AS engine_status,
        k AS fuel_level_percent, k * 0.6 AS remaining_fuel_liters, value AS odometer_km FROM keyed_events""",
    "scans": """SELECT l_orderkey AS order_id, l_shipdate AS scan_time, l_suppkey AS route_id, l_partkey AS driver_id,
        CASE l_returnflag WHEN 'A' THEN 'delivered' WHEN 'R' THEN 'delayed' ELSE 'in_transit' END AS scan_status,
        l_linestatus AS location FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
            l_suppkey DESC, l_partkey DESC, l_extendedprice DESC, scan_status DESC, location DESC) = 1""",
    # Scans as a raw file has them, without the line number that settles equal times elsewhere.
    "file_scans": """SELECT l_orderkey, l_shipdate AS seen, l_linestatus AS place,
        CASE l_returnflag WHEN 'A' THEN 'delivered' WHEN 'R' THEN 'delayed' ELSE 'in_transit' END AS outcome FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY seen DESC, outcome DESC, place DESC) = 1""",
    "fact_delivery": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_custkey AS vehicle_id,
        o_orderdate AS promised_time,
        CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Delayed' ELSE 'in_transit' END AS status,
        scan_time, coalesce(scan_status, '') AS scan_status, route_id, driver_id, coalesce(location, '') AS location
        FROM orders LEFT JOIN scans ON o_orderkey = order_id""",
    "fact_fuel": """SELECT concat(l_orderkey, '-', l_linenumber) AS fuel_key, o_custkey AS vehicle_id,
        l_shipdate AS ts, l_quantity AS liters, l_extendedprice AS amount, l_returnflag AS fuel_type,
        CAST(l_partkey AS DOUBLE) AS odometer_km FROM ordered_lines""",
    "fact_maintenance": """SELECT concat(l_orderkey, '-', l_linenumber) AS work_order_id, o_custkey AS vehicle_id,
        l_linestatus AS issue, o_orderdate AS opened_at, l_shipdate AS closed_at,
        substring(o_orderpriority, 3) AS priority, l_extendedprice * l_tax AS cost,
        round((epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0, 2) AS downtime_hours FROM ordered_lines""",
    "latest": "SELECT * FROM fact_gps QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, gps_key DESC) = 1",
    "live": """SELECT v.vehicle_id, type, model, depot_id, ts, latitude, longitude, speed
        FROM dim_vehicle v JOIN fact_gps g ON g.vehicle_id = v.vehicle_id
        WHERE ts = (SELECT max(n.ts) FROM fact_gps n WHERE n.vehicle_id = v.vehicle_id)""",
    "trend": f"""SELECT strftime(promised_time, '%Y-%m-%d') AS date, count(*) AS total_deliveries,
        {DONE} AS delivered, {LATE} AS delayed, {pct(DONE, 'count(*)')} AS on_time_rate,
        {pct(LATE, 'count(*)')} AS delay_rate FROM fact_delivery GROUP BY 1""",
    "efficiency": f"""SELECT vehicle_id, {s2('liters')} AS fuel_liters,
        {r2('max(odometer_km) - min(odometer_km)')} AS distance_km,
        {r2(div('max(odometer_km) - min(odometer_km)', f'sum({dec("liters")})'))} AS km_per_liter,
        {s2('amount')} AS fuel_cost, count(*) AS fuel_events FROM fact_fuel GROUP BY vehicle_id""",
    "delivery_cost": f"""SELECT *, {r2(div('fuel_cost', 'deliveries'))} AS cost_per_delivery
        FROM (SELECT vehicle_id, coalesce((SELECT CAST(sum({dec('amount')}) AS DOUBLE) FROM fact_fuel f WHERE f.vehicle_id = v.vehicle_id), 0)
            AS fuel_cost,
        (SELECT count(*) FROM fact_delivery d WHERE d.vehicle_id = v.vehicle_id) AS deliveries FROM dim_vehicle v)""",
    "upkeep": f"""SELECT vehicle_id, count(*) AS work_orders, {s2('downtime_hours')} AS downtime_hours,
        {mean('downtime_hours')} AS average_downtime_hours, {s2('cost')} AS maintenance_cost,
        count(*) FILTER (WHERE lower(priority) = 'high') AS high_priority_orders
        FROM fact_maintenance GROUP BY vehicle_id""",
    "route_kpi": f"""SELECT r.route_id, origin, destination, distance_km, expected_duration_min,
        count(order_id) AS total_orders, {DONE} AS delivered_orders, {LATE} AS delayed_orders,
        {pct(LATE, 'count(order_id)')} AS delay_rate
        FROM dim_route r LEFT JOIN fact_delivery d ON r.route_id = d.route_id GROUP BY ALL""",
    # Facts joined row by row, before any grouping: the form the grouped Spark plan has to equal.
    "vehicle_report": f"""SELECT v.vehicle_id, type, model, depot_id, capacity,
        count(DISTINCT order_id) AS deliveries, count(DISTINCT ts) AS gps_events, {mean('speed')} AS average_speed,
        {r2('max(speed)')} AS maximum_speed, coalesce(km_per_liter, 0) AS km_per_liter,
        coalesce(cost_per_delivery, 0) AS cost_per_delivery, coalesce(u.downtime_hours, 0) AS maintenance_downtime_hours
        FROM dim_vehicle v LEFT JOIN fact_delivery d ON d.vehicle_id = v.vehicle_id
        LEFT JOIN fact_gps g ON g.vehicle_id = v.vehicle_id LEFT JOIN efficiency e ON e.vehicle_id = v.vehicle_id
        LEFT JOIN delivery_cost c ON c.vehicle_id = v.vehicle_id LEFT JOIN upkeep u ON u.vehicle_id = v.vehicle_id
        GROUP BY v.vehicle_id, type, model, depot_id, capacity, e.km_per_liter, c.cost_per_delivery, u.downtime_hours""",
    "depot_report": f"""SELECT depot_id, count(DISTINCT vehicle_id) AS vehicles,
        (SELECT count(DISTINCT order_id) FROM dim_vehicle v JOIN fact_delivery USING (vehicle_id)
            WHERE v.depot_id = o.depot_id) AS deliveries,
        coalesce((SELECT {mean('speed')} FROM dim_vehicle v JOIN fact_gps USING (vehicle_id)
            WHERE v.depot_id = o.depot_id), 0) AS average_speed,
        coalesce((SELECT {s2('amount')} FROM dim_vehicle v JOIN fact_fuel USING (vehicle_id)
            WHERE v.depot_id = o.depot_id), 0) AS fuel_cost,
        coalesce((SELECT {s2('downtime_hours')} FROM dim_vehicle v JOIN fact_maintenance USING (vehicle_id)
            WHERE v.depot_id = o.depot_id), 0) AS maintenance_downtime
        FROM dim_vehicle o GROUP BY depot_id""",
    "found": """SELECT 'DELAYED_ROUTE' AS exception_type, CAST(route_id AS VARCHAR) AS entity_id, 'HIGH' AS severity,
            delay_rate AS metric_value, 'Route has elevated delivery delay rate' AS description
            FROM route_kpi WHERE total_orders > 0 AND delay_rate >= 20
        UNION ALL SELECT 'LOW_FUEL_EFFICIENCY', CAST(vehicle_id AS VARCHAR), 'MEDIUM', km_per_liter,
            'Vehicle has low fuel efficiency' FROM efficiency WHERE km_per_liter > 0 AND km_per_liter < 8
        UNION ALL SELECT 'HIGH_MAINTENANCE_DOWNTIME', CAST(vehicle_id AS VARCHAR), 'HIGH', downtime_hours,
            'Vehicle has high maintenance downtime' FROM upkeep WHERE downtime_hours >= 24""",
    "gps_messages": """SELECT *, unnest(CASE WHEN event_type = 'purchase' THEN [0, 1] ELSE [0] END) AS part
        FROM keyed_events""",
    "clean_gps": f"""SELECT concat('V', user_id) AS vehicle_id, ts, k AS latitude, value AS longitude, value AS speed,
        event_id, part, event_type FROM gps_messages WHERE {GOOD_GPS}
        QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id, part) = 1""",
    "outcomes": f"""SELECT '{GPS_TOPIC}' AS topic, CASE WHEN event_type = 'error' THEN 'malformed_json'
            WHEN NOT k BETWEEN -90 AND 90 THEN 'bad_latitude' WHEN NOT value BETWEEN -180 AND 180 THEN 'bad_longitude'
            WHEN value < 0 THEN 'bad_speed' END AS reason FROM gps_messages
        UNION ALL SELECT '{DELIVERY_TOPIC}', CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'bad_status' END FROM orders
        UNION ALL SELECT '{VEHICLE_TOPIC}', CASE WHEN event_type = 'signup' THEN 'missing_field'
            WHEN NOT value BETWEEN 0 AND 100 THEN 'bad_fuel_level' END FROM events""",
}


# What the checks ask, written out here so that a wrong rule of the engine can't pass on both sides.
FILLED = (
    "dim_vehicle.vehicle_id dim_driver.driver_id dim_route.route_id dim_customer.customer_id fact_delivery.order_id "
    "fact_fuel.vehicle_id fact_maintenance.work_order_id fact_gps.vehicle_id"
).split()
SINGLE = (
    "dim_vehicle.vehicle_id dim_driver.driver_id dim_route.route_id dim_customer.customer_id fact_delivery.order_id "
    "fact_maintenance.work_order_id"
).split()
WRONG = {
    "GPS latitude": "fact_gps WHERE latitude NOT BETWEEN -90 AND 90",
    "GPS longitude": "fact_gps WHERE longitude NOT BETWEEN -180 AND 180",
    "GPS speed": "fact_gps WHERE NOT speed >= 0",
    "Fuel liters": "fact_fuel WHERE NOT liters > 0",
    "Fuel amount": "fact_fuel WHERE NOT amount >= 0",
    "Telemetry fuel %": "fact_vehicle_telemetry WHERE fuel_level_percent NOT BETWEEN 0 AND 100",
    "Telemetry remaining fuel": "fact_vehicle_telemetry WHERE NOT remaining_fuel_liters >= 0",
    "Maintenance cost": "fact_maintenance WHERE NOT cost >= 0",
    "Maintenance downtime": "fact_maintenance WHERE NOT downtime_hours >= 0",
}
LINKS = {
    "delivery -> vehicle": "fact_delivery dim_vehicle vehicle_id",
    "delivery -> driver": "fact_delivery dim_driver driver_id",
    "delivery -> route": "fact_delivery dim_route route_id",
    "delivery -> customer": "fact_delivery dim_customer customer_id",
    "fuel -> vehicle": "fact_fuel dim_vehicle vehicle_id",
    "maintenance -> vehicle": "fact_maintenance dim_vehicle vehicle_id",
    "gps -> vehicle": "fact_gps dim_vehicle vehicle_id",
}


def _checks() -> dict[str, str]:
    """One query per check, each on its own scan."""
    row = "SELECT '{}' AS check_family, '{}' AS check_name, {} AS value, CASE WHEN {} THEN 'PASS' ELSE 'FAIL' END AS status"

    def check(family: str, name: str, value: str, source: str, passed: str = "value = 0") -> str:
        return f"{row.format(family, name, 'value', passed)} FROM (SELECT {value} AS value FROM {source})"

    volume = [check("volume", t, "count(*)", t, "value > 0") for t in TABLES]
    complete = [
        check("completeness", f"{t}.{c}", "count(*)", f"{t} WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = ''")
        for t, c in (x.split(".") for x in FILLED)
    ]
    ranges = [check("range", name, "count(*)", source) for name, source in WRONG.items()]
    keys = [x.split(".") for x in SINGLE]
    unique = [check("uniqueness", f"{t}.{c}", f"count(*) - count(DISTINCT {c})", t) for t, c in keys]
    references = [
        check("reference", name, "count(*)", f"{fact} f LEFT JOIN {dim} d ON f.{key} = d.{key} WHERE d.{key} IS NULL")
        for name, (fact, dim, key) in ((n, x.split()) for n, x in LINKS.items())
    ]
    return {
        "row_checks": " UNION ALL ".join(volume + complete + ranges),
        "uniqueness_checks": " UNION ALL ".join(
            f"SELECT *, (SELECT count(*) FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)) AS duplicate_keys "
            f"FROM ({sql})"
            for (t, c), sql in zip(keys, unique)
        ),
        "reference_checks": " UNION ALL ".join(references),
        "all_checks": " UNION ALL ".join(volume + complete + ranges + unique + references),
    }


POSITION = f"vehicle_id, {when('ts')} AS timestamp, latitude, longitude, speed"
LIVE = f"vehicle_id, type, model, depot_id, {when('ts')} AS timestamp, latitude, longitude, speed"
FUEL = f"""SELECT fuel_key, vehicle_id, {when('ts')} AS timestamp, liters, amount, fuel_type, odometer_km FROM fact_fuel
    ORDER BY ts DESC, fuel_key, vehicle_id, liters, amount, fuel_type, odometer_km LIMIT """
WORK = f"""work_order_id, vehicle_id, issue, {when('opened_at')} AS opened_at, {when('closed_at')} AS closed_at, priority,
    cost, downtime_hours"""
MAINTENANCE = f"""SELECT work_order_id AS maintenance_key, {WORK} FROM fact_maintenance m
    ORDER BY m.opened_at DESC, work_order_id, vehicle_id, issue, m.closed_at, priority, cost, downtime_hours LIMIT """
ROUTES = "SELECT route_key, route_id, origin, destination, distance_km, expected_duration_min FROM dim_route"
COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES)
CLEAN = f"""SELECT {POSITION}, '{GPS_TOPIC}' AS _kafka_topic, event_id AS _offset, event_type AS kind"""

# Columns whose text is the same in every engine.
PRINTED = {
    "dim_depot": "depot_id depot_name city capacity", "dim_vehicle": "vehicle_id type model depot_id", "dim_route": "route_id destination",
    "dim_date": "date_key date quarter", "fact_delivery": "order_id vehicle_id status scan_status route_id location",
    "fact_fuel": "fuel_key vehicle_id fuel_type", "fact_gps": "gps_key vehicle_id",
    "fact_maintenance": "work_order_id issue priority",
}
PRINTS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column, count(*) AS rows, count({c}) AS filled,
        CAST(sum(CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 15) AS BIGINT)) AS VARCHAR) AS fingerprint FROM {t}"""
    for t, columns in PRINTED.items()
    for c in columns.split()
)
SECONDS = lambda x: when(f"date_trunc('second', {x})")
# Lines of a file in which every seventh row is cut in three, and what a row that is not cut may have.
CUT, LONG, BAD, NO_SPEED = (f"gps_key % {n} = 0" for n in (7, 11, 13, 17))
WHOLE = f"NOT {CUT} AND ({NO_SPEED}) = ({LONG})"
FAULTS = {
    "open_quote": f"2 * count(*) FILTER (WHERE {CUT})",
    "too_long": f"count(*) FILTER (WHERE NOT {CUT} AND {LONG} AND NOT {NO_SPEED})",
    "short": f"count(*) FILTER (WHERE {CUT} OR {NO_SPEED} AND NOT {LONG})",
}
FAULT_ROWS = {
    **FAULTS,
    **{f"refused {name}": n for name, n in FAULTS.items()},
    **{f"unreadable {c}": "0" for c in ("timestamp", "latitude", "longitude")},
    "unreadable speed": f"count(*) FILTER (WHERE {WHOLE} AND ({NO_SPEED} OR {BAD}))",
    "loaded": f"count(*) FILTER (WHERE {WHOLE})",
}

QUERIES = {
    "row_counts": COUNTS,
    "warehouse_rebuild": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, true AS refused FROM {t}"
        for t in ("dim_depot", "dim_vehicle", "dim_driver", "dim_route", "fact_gps", "fact_trip")
    ),
    "copy_fingerprints": PRINTS,
    "csv_depots": "SELECT CAST(depot_id AS VARCHAR) AS depot_id, depot_name, city, capacity FROM dim_depot",
    "csv_drivers": """SELECT CAST(p_partkey AS VARCHAR) AS driver_id, p_name AS name, CAST(p_partkey % 25 AS VARCHAR) AS depot_id,
        CAST(p_size AS BIGINT) AS experience_years, p_brand AS shift FROM part""",
    "csv_routes": """SELECT CAST(route_id AS VARCHAR) AS route_id, CAST(origin AS VARCHAR) AS origin, destination, distance_km,
        expected_duration_min FROM dim_route""",
    "csv_customers": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, CAST(c_nationkey AS VARCHAR) AS city,
        c_mktsegment AS service_area FROM customer""",
    "csv_fuel": f"""SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id, {SECONDS('ts')} AS timestamp, liters, amount, fuel_type,
        odometer_km FROM fact_fuel""",
    "csv_gps": f"""SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id, {SECONDS('ts')} AS timestamp, latitude, longitude, speed
        FROM fact_gps""",
    "csv_telemetry": f"""SELECT CAST(user_id AS VARCHAR) AS vehicle_id, {SECONDS('ts')} AS timestamp,
        CASE WHEN event_type IN ('click', 'view') THEN 'ON' ELSE 'OFF' END AS engine_status, k AS fuel_level_percent,
        k * 0.6 AS remaining_fuel_liters, value AS odometer_km FROM keyed_events""",
    "csv_maintenance": f"""SELECT work_order_id, CAST(vehicle_id AS VARCHAR) AS vehicle_id, issue, {SECONDS('opened_at')} AS opened_at,
        {SECONDS('closed_at')} AS closed_at, priority, cost, downtime_hours FROM fact_maintenance""",
    "load_faults": " UNION ALL ".join(
        f"SELECT '{name}' AS fault, CAST({n} AS BIGINT) AS rows" + (" FROM fact_gps" if "count" in n else "")
        for name, n in FAULT_ROWS.items()
    ),
    "warehouse_copy": COUNTS,
    "warehouse_layout": """SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS rows,
        count(DISTINCT vehicle_id) AS vehicles FROM fact_gps GROUP BY 1""",
    "csv_vehicles": """SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id, type, CAST(depot_id AS VARCHAR) AS depot_id,
        CAST(NULL AS BIGINT) AS capacity, model, CAST(60 AS DOUBLE) AS fuel_capacity_liters FROM dim_vehicle""",
    "csv_deliveries": f"""SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
        CAST(d.route_id AS VARCHAR) AS route_id, CAST(vehicle_id AS VARCHAR) AS vehicle_id,
        CAST(d.driver_id AS VARCHAR) AS driver_id, {when('promised_time')} AS promised_time, status,
        {when('s.seen')} AS scan_time, coalesce(s.outcome, '') AS scan_status, coalesce(s.place, '') AS location
        FROM fact_delivery d LEFT JOIN file_scans s ON s.l_orderkey = order_id""",
    "dim_depot": "SELECT * FROM dim_depot",
    "dim_date": "SELECT * FROM dim_date",
    "fact_delivery": f"""SELECT * REPLACE ({when('promised_time')} AS promised_time, {when('scan_time')} AS scan_time)
        FROM fact_delivery""",
    "fact_maintenance": f"SELECT {WORK} FROM fact_maintenance",
    "fact_trip": f"SELECT gps_key AS trip_key, {POSITION} FROM fact_trip",
    "duplicate_work_orders": """SELECT work_order_id AS key, count(*) AS rows FROM fact_maintenance
        GROUP BY work_order_id HAVING count(*) > 1""",
    "delivery_trend": "SELECT * FROM trend",
    "fuel_efficiency": "SELECT * FROM efficiency",
    "cost_per_delivery": "SELECT * FROM delivery_cost",
    "idle_time": """SELECT vehicle_id, count(*) AS telemetry_events,
        count(*) FILTER (WHERE engine_status = 'ON' AND fuel_level_percent >= 0) AS engine_on_events,
        count(odometer_km) FILTER (WHERE engine_status = 'ON') AS active_engine_events
        FROM fact_vehicle_telemetry GROUP BY vehicle_id""",
    "maintenance_kpi": "SELECT * FROM upkeep",
    "route_performance": "SELECT * FROM route_kpi",
    "vehicle_kpi": "SELECT * FROM vehicle_report",
    "depot_performance": "SELECT * FROM depot_report",
    "executive_kpis": f"""SELECT *, total_fuel_cost / nullif(total_deliveries, 0) AS fleet_cost_per_delivery
        FROM (SELECT (SELECT count(*) FROM dim_vehicle) AS total_vehicles,
        (SELECT count(*) FROM dim_driver) AS total_drivers, (SELECT count(*) FROM dim_route) AS total_routes,
        (SELECT count(*) FROM fact_delivery) AS total_deliveries,
        (SELECT {pct(DONE, 'count(*)')} FROM fact_delivery) AS on_time_delivery_rate,
        (SELECT {s2('liters')} FROM fact_fuel) AS total_fuel_liters,
        (SELECT {s2('amount')} FROM fact_fuel) AS total_fuel_cost,
        (SELECT {r2(div('max(odometer_km) - min(odometer_km)', f'sum({dec("liters")})'))} FROM fact_fuel)
            AS fleet_km_per_liter,
        (SELECT {s2('downtime_hours')} FROM fact_maintenance) AS total_maintenance_downtime_hours,
        (SELECT count(*) FROM fact_maintenance) AS total_maintenance_work_orders)""",
    "exceptions": "SELECT * FROM found",
    "published_views": """SELECT exception_type, severity, count(*) AS found, max(metric_value) AS worst FROM found
        GROUP BY exception_type, severity""",
    "published_rows": " UNION ALL ".join(
        f"SELECT '{view}' AS view_name, count(*) AS rows FROM {table}"
        for view, table in (
            ("vw_delivery_trend", "trend"), ("vw_fuel_efficiency", "efficiency"), ("vw_cost_per_delivery", "delivery_cost"),
            ("vw_idle_time", "(SELECT DISTINCT vehicle_id FROM fact_vehicle_telemetry)"), ("vw_maintenance_kpi", "upkeep"),
            ("vw_route_performance", "route_kpi"), ("vw_vehicle_kpi", "vehicle_report"), ("vw_depot_performance", "depot_report"),
            ("vw_executive_kpis", "(SELECT 1)"), ("vw_exceptions", "found"),
        )
    ),
    "first_trend_days": "SELECT * FROM trend ORDER BY date LIMIT 20",
    "worst_routes": """SELECT route_id, origin, destination, total_orders, delayed_orders, delay_rate FROM route_kpi
        WHERE total_orders > 0 ORDER BY delay_rate DESC, route_id LIMIT 10""",
    "busiest_vehicles": """SELECT vehicle_id, type, model, depot_id, deliveries, average_speed, km_per_liter,
        cost_per_delivery, maintenance_downtime_hours FROM vehicle_report ORDER BY deliveries DESC, vehicle_id LIMIT 10""",
    "depot_ranking": "SELECT * FROM depot_report ORDER BY deliveries DESC, depot_id",
    "top_exceptions": """SELECT * FROM found ORDER BY CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END,
        metric_value DESC, exception_type, entity_id LIMIT 20""",
    "recent_fuel": f"{FUEL} 100",
    "recent_maintenance": f"{MAINTENANCE} 100",
    "dashboard_summary": f"""SELECT *, coalesce({r2(div('fuel_cost', 'deliveries'))}, 0) AS fuel_cost_per_delivery
        FROM (SELECT (SELECT count(*) FROM dim_vehicle) AS vehicles,
        (SELECT count(*) FROM dim_driver) AS drivers, (SELECT count(*) FROM dim_route) AS routes,
        (SELECT count(*) FROM fact_delivery) AS deliveries,
        (SELECT coalesce({pct("count(*) FILTER (WHERE scan_time <= promised_time)", 'count(*)')}, 0)
            FROM fact_delivery WHERE lower(status) = 'delivered') AS on_time_delivery_rate_percent,
        (SELECT coalesce({s2('liters')}, 0) FROM fact_fuel) AS fuel_liters,
        (SELECT coalesce({s2('amount')}, 0) FROM fact_fuel) AS fuel_cost,
        (SELECT coalesce({s2('downtime_hours')}, 0) FROM fact_maintenance) AS maintenance_downtime_hours,
        (SELECT count(*) FROM fact_maintenance) AS maintenance_work_orders)""",
    "delivery_performance": f"""SELECT delivered + delayed AS total_deliveries, delivered, delayed,
        coalesce({pct('delivered', 'delivered + delayed')}, 0) AS on_time_rate_percent
        FROM (SELECT count(*) FILTER (WHERE scan_status = 'delivered') AS delivered,
            count(*) FILTER (WHERE scan_status = 'delayed') AS delayed FROM fact_delivery)""",
    "fuel_by_type": f"""SELECT fuel_type, {s2('liters')} AS total_liters, {s2('amount')} AS total_cost
        FROM fact_fuel GROUP BY fuel_type""",
    "maintenance_by_priority": f"""SELECT priority, count(*) AS work_orders, {s2('cost')} AS total_cost,
        {s2('downtime_hours')} AS total_downtime_hours FROM fact_maintenance GROUP BY priority""",
    "fleet_status": f"""SELECT count(*) FILTER (WHERE s = 'Moving') AS moving, count(*) FILTER (WHERE s = 'Idle') AS idle,
        count(*) FILTER (WHERE s = 'Stopped') AS stopped, count(*) AS total FROM (SELECT {STATUS} AS s FROM latest)""",
    "bounding_box": """SELECT min(latitude) AS south, max(latitude) AS north, min(longitude) AS west,
        max(longitude) AS east FROM latest""",
    "alert_counters": f"""SELECT (SELECT least(count(*), 10) FROM clean_gps WHERE speed > 70) AS overspeed,
        (SELECT count(*) FROM clean_gps WHERE speed > 70) AS overspeed_total,
        (SELECT count(*) FROM latest WHERE {STATUS} = 'Stopped') AS stopped,
        (SELECT count(*) FROM latest WHERE {STATUS} = 'Idle') AS idle,
        (SELECT count(*) FROM fact_delivery WHERE scan_status = 'delayed') AS delayed""",
    "overspeed_alerts": f"""SELECT vehicle_id, speed, {when('ts')} AS timestamp,
        CAST(round(CAST(speed AS DECIMAL(38,8)), 1) AS DOUBLE) AS shown_speed
        FROM fact_gps WHERE speed > 70 ORDER BY speed DESC, gps_key LIMIT 10""",
    "overspeed_positions": f"SELECT gps_key, {POSITION} FROM fact_gps WHERE speed > 70",
    "motion_status": f"""SELECT gps_key, {STATUS} AS status,
        CASE WHEN speed = 0 THEN 'Stopped' WHEN speed < 10 THEN 'Idle' ELSE 'Moving' END AS popup_status FROM fact_gps""",
    "route_list": ROUTES,
    "route_page": f"{ROUTES} ORDER BY route_key LIMIT 12",
    "route_filter": f"{ROUTES} WHERE route_id = 7",
    "fuel_page": f"{FUEL} 15",
    "maintenance_page": f"{MAINTENANCE} 15",
    "latest_position": f"SELECT gps_key, {POSITION} FROM latest",
    "latest_position_ties": f"""SELECT gps_key, {POSITION} FROM fact_gps g
        WHERE ts = (SELECT max(n.ts) FROM fact_gps n WHERE n.vehicle_id = g.vehicle_id)""",
    "live_fleet": f"SELECT {LIVE} FROM live",
    "idle_fleet": f"SELECT {LIVE}, {STATUS} AS status FROM live WHERE {STATUS} = 'Idle'",
    "fleet_page": f"SELECT {LIVE}, {STATUS} AS status FROM live ORDER BY vehicle_id, speed LIMIT 30",
    "latest_with_vehicle": f"""SELECT l.vehicle_id, {when('ts')} AS timestamp, latitude, longitude, speed, type, model
        FROM latest l LEFT JOIN dim_vehicle v ON v.vehicle_id = l.vehicle_id""",
    "trail_points": """SELECT vehicle_id, CAST(row_number() OVER (PARTITION BY vehicle_id ORDER BY ts, gps_key) - 1
            AS INTEGER) AS position, latitude, longitude
        FROM (SELECT *, count(*) OVER (PARTITION BY vehicle_id) AS points FROM fact_gps
            WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND vehicle_id IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, gps_key DESC) <= 15)
        WHERE points > 1""",
    **_checks(),
    "health_summary": """SELECT *, concat_ws(',', CASE WHEN vehicle_count = 0 THEN 'vehicle_count' END,
            CASE WHEN null_vehicle_ids > 0 THEN 'null_vehicle_ids' END,
            CASE WHEN duplicate_vehicle_ids > 0 THEN 'duplicate_vehicle_ids' END,
            CASE WHEN invalid_gps_vehicle_references > 0 THEN 'invalid_gps_vehicle_references' END,
            CASE WHEN invalid_gps_speed > 0 THEN 'invalid_gps_speed' END,
            CASE WHEN delivery_count = 0 THEN 'delivery_count' END, CASE WHEN fuel_count = 0 THEN 'fuel_count' END,
            CASE WHEN maintenance_count = 0 THEN 'maintenance_count' END) AS failed_checks,
        CASE WHEN failed_checks = '' THEN 'healthy' ELSE 'warning' END AS status
        FROM (SELECT (SELECT count(*) FROM dim_vehicle) AS vehicle_count,
            (SELECT count(*) FROM dim_vehicle WHERE vehicle_id IS NULL) AS null_vehicle_ids,
            (SELECT count(*) FROM (SELECT 1 FROM dim_vehicle GROUP BY vehicle_id HAVING count(*) > 1))
                AS duplicate_vehicle_ids,
            (SELECT count(*) FROM fact_gps g WHERE NOT EXISTS
                (SELECT 1 FROM dim_vehicle v WHERE v.vehicle_id = g.vehicle_id)) AS invalid_gps_vehicle_references,
            (SELECT count(*) FROM fact_gps WHERE speed < 0 OR speed > 200) AS invalid_gps_speed,
            (SELECT count(*) FROM fact_delivery) AS delivery_count, (SELECT count(*) FROM fact_fuel) AS fuel_count,
            (SELECT count(*) FROM fact_maintenance) AS maintenance_count)""",
    "unknown_gps_routes": """SELECT vehicle_id AS key, count(*) AS rows FROM fact_gps
        WHERE vehicle_id NOT IN (SELECT route_id FROM dim_route) GROUP BY vehicle_id""",
    "silver_gps": f"{CLEAN}, part AS _partition FROM clean_gps",
    "silver_delivery": f"""SELECT concat('O', o_orderkey) AS order_id, concat('V', o_custkey) AS vehicle_id,
        {when('o_orderdate')} AS timestamp,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'in_transit' ELSE 'lost' END AS status,
        o_orderpriority AS location, '{DELIVERY_TOPIC}' AS _kafka_topic, 0 AS _partition, o_orderkey AS _offset
        FROM orders WHERE status IN ({STATUSES})""",
    "silver_vehicle": f"""SELECT concat('V', user_id) AS vehicle_id, {when('ts')} AS timestamp,
        CASE WHEN event_type IN ('click', 'view') THEN 'ON' ELSE 'OFF' END AS engine_status, value AS fuel_level,
        '{VEHICLE_TOPIC}' AS _kafka_topic, 0 AS _partition, event_id AS _offset
        FROM events WHERE event_type <> 'signup' AND value BETWEEN 0 AND 100""",
    "silver_page": f"SELECT {POSITION} FROM clean_gps ORDER BY vehicle_id, ts LIMIT 10",
    "silver_latest": f"""SELECT {POSITION} FROM clean_gps
        QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, event_id, part) = 1""",
    "silver_overspeed": f"""SELECT vehicle_id, speed, {when('ts')} AS timestamp,
        CAST(round(CAST(speed AS DECIMAL(38,8)), 1) AS DOUBLE) AS shown_speed
        FROM clean_gps WHERE speed > 70 ORDER BY speed DESC, vehicle_id, ts LIMIT 10""",
    "silver_trails": """SELECT vehicle_id, CAST(row_number() OVER (PARTITION BY vehicle_id ORDER BY ts) - 1 AS INTEGER) AS position,
            latitude, longitude
        FROM (SELECT *, count(*) OVER (PARTITION BY vehicle_id) AS points FROM clean_gps
            QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC) <= 15)
        WHERE points > 1""",
    "silver_box": """SELECT min(latitude) AS south, max(latitude) AS north, min(longitude) AS west, max(longitude) AS east
        FROM (SELECT * FROM clean_gps QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC) = 1)""",
    "silver_with_vehicle": f"""SELECT l.vehicle_id, {when('ts')} AS timestamp, latitude, longitude, speed, type, model
        FROM (SELECT * FROM clean_gps QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC) = 1) l
        LEFT JOIN dim_vehicle v ON l.vehicle_id = concat('V', v.vehicle_id)""",
    "silver_file_order": """SELECT CAST(count(*) AS BIGINT) AS rows, min(vehicle_id) AS first_vehicle, max(vehicle_id) AS last_vehicle,
        true AS several_files, CAST(0 AS BIGINT) AS overlapping_files FROM clean_gps""",
    "stream_counts": "SELECT topic, reason AS reject_reason, count(*) AS events FROM outcomes GROUP BY topic, reason",
    "bronze_topics": f"""SELECT '{GPS_TOPIC}' AS kafka_topic, count(*) AS messages,
            count(*) FILTER (WHERE event_type = 'error') AS unreadable, max(event_id) AS last_offset FROM gps_messages
        UNION ALL SELECT '{DELIVERY_TOPIC}', count(*), 0, max(o_orderkey) FROM orders
        UNION ALL SELECT '{VEHICLE_TOPIC}', count(*), 0, max(event_id) FROM events""",
    "topic_counts": """SELECT topic, count(*) FILTER (WHERE reason IS NULL) AS processed, count(reason) AS rejected
        FROM outcomes GROUP BY topic""",
    "reject_counts": """SELECT topic, reason AS reject_reason, count(*) AS events FROM outcomes WHERE reason IS NOT NULL
        GROUP BY topic, reason""",
    "refined_tables": f"""SELECT topic, CASE WHEN topic = '{GPS_TOPIC}' THEN (SELECT count(*) FROM clean_gps)
            ELSE count(*) FILTER (WHERE reason IS NULL) END AS silver_rows, count(reason) AS quarantine_rows
        FROM outcomes GROUP BY topic
        UNION ALL SELECT CASE n_nationkey % 3 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_topic' ELSE 'unknown_topic' END,
            0, count(*) FROM nation GROUP BY 1""",
    "bronze_ingest": f"""SELECT '{GPS_TOPIC}' AS kafka_topic, part AS partition, event_id AS offset,
        CASE WHEN event_type <> 'error' THEN concat('V', user_id) END AS vehicle_id,
        CASE WHEN event_type = 'error' THEN CAST(length(concat('{{"vehicle_id":"V', user_id, '","timestamp":"',
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00","latitude":', k, ',"longitude":', value, ',"speed":', value,
            ',"kind":"error')) AS INTEGER) END AS raw_length FROM gps_messages""",
    "silver_stream": f"{CLEAN} FROM clean_gps",
    "live_stream": f"""SELECT {POSITION}, {STATUS} AS status, speed > 70 AS overspeed FROM clean_gps
        QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, event_id, part) = 1""",
    "model_features": """SELECT l_orderkey, l_linenumber, l_quantity * 10 AS feature_0,
        20 + l_discount * CAST(800 AS DOUBLE) AS feature_1, CAST(10 + l_partkey % 91 AS DOUBLE) AS feature_2
        FROM lineitem""",
    "model_split": """SELECT l_orderkey, l_linenumber, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', 42, l_orderkey,
        l_linenumber)), 1, 8) AS BIGINT) % 1000 >= 200 THEN 'train' ELSE 'test' END AS side FROM lineitem""",
}


def _needed(sql: str, found: dict[str, None] | None = None) -> dict[str, None]:
    """The table definitions a statement uses, each after the ones it builds on."""
    found = {} if found is None else found
    for name in CTES:
        if name not in found and CTES[name] and re.search(rf"\b{name}\b", sql):
            _needed(CTES[name], found)
            found[name] = None
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, sql in QUERIES.items():
        tables = ",\n".join(f"{t} AS ({CTES[t]})" for t in _needed(sql))
        statements[name] = f"WITH {tables}\n{sql}" if tables else sql
    return statements
