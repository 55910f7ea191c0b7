"""Every operator as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy.functions.predicates import motion_status, overspeed, popup_status
from convoy.operators import kpi, latest, lookup, ml, quality, reports, serving, silver
from convoy.operators.lookup import attach_last_scan
from convoy.plans.kpi_views import kpi_view, publish_kpis
from convoy.plans.refine import read_quarantine, read_silver, read_unrouted, refine_bronze
from convoy.plans.warehouse import ORDER_COLUMNS, read_maintenance, read_orders, read_scans, trips_from_gps
from convoy.schemas import BUSINESS_KEYS
from convoy.session import work_dir
from convoy.sources import bronze
from convoy.sources.csv import LOADS, faults, kinds_of, load_csv, read_refused
from convoy.sources.sample import SampleFleet
from convoy.sources.tables import (
    LoadError,
    View,
    copy_tables,
    fingerprints,
    read_table,
    rebuild_tables,
    write_table,
)
from convoy.streaming.ingest import write_bronze
from convoy.streaming.live import read_live, write_live
from convoy.streaming.refine import read_stream_counts, read_stream_silver, write_silver

Query = Callable[[SparkSession, str], DataFrame]

FLEET_PAGE, ROUTE_PAGE, FUEL_PAGE, MAINTENANCE_PAGE, SILVER_PAGE = 30, 12, 15, 15, 10
ONE_ROUTE = 7


def plain(df: DataFrame) -> DataFrame:
    """Times as text of one fixed form, which every engine prints alike."""
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in times}) if times else df


def _over(build: Callable[[SampleFleet], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(SampleFleet(spark, sf_dir)))


def _view(name: str) -> Query:
    return _over(lambda t: kpi_view(t, name))


def _trend(t: SampleFleet) -> DataFrame:
    return kpi.delivery_trend(t["fact_delivery"])


def _routes(t: SampleFleet) -> DataFrame:
    return kpi.route_performance(t["dim_route"], t["fact_delivery"])


def _headline(t: SampleFleet) -> tuple[DataFrame, ...]:
    names = ("dim_vehicle", "dim_driver", "dim_route", "fact_delivery", "fact_fuel", "fact_maintenance")
    return tuple(t[n] for n in names)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exceptions per type, asked in SQL of the published views."""
    publish_kpis(SampleFleet(spark, sf_dir))
    return spark.sql(
        "SELECT exception_type, severity, count(*) AS found, max(metric_value) AS worst "
        "FROM vw_exceptions GROUP BY exception_type, severity"
    )


# Events


def _gps(t: SampleFleet) -> DataFrame:
    return bronze.envelope_from_messages(t.gps_messages())


def _lines(messages: DataFrame) -> DataFrame:
    """Messages as lines of a Bronze file."""
    line = F.format_string('{"kafka_topic":"%s","partition":%d,"offset":%d,"event":%s}', "topic", "partition", "offset", "value")
    return messages.select(line.alias("value"))


def _all_envelopes(t: SampleFleet) -> DataFrame:
    others = t.delivery_messages.unionByName(t.vehicle_messages)
    return _gps(t).unionByName(bronze.envelope_from_lines(_lines(others)))


def _silver(t: SampleFleet) -> DataFrame:
    return silver.silver_gps(_gps(t))


def _record(df: DataFrame) -> DataFrame:
    """A clean position with its lineage and one field the rules do not know."""
    return df.select(
        "vehicle_id",
        "timestamp",
        "latitude",
        "longitude",
        "speed",
        *silver.LINEAGE,
        F.try_variant_get("event", "$.kind", "string").alias("kind"),
    )


def _checked(t: SampleFleet) -> DataFrame:
    frames = [silver.check_events(_gps(t), silver.GPS_RULES).select(*silver.LINEAGE, "reject_reason")]
    for messages, rules in ((t.delivery_messages, silver.DELIVERY_RULES), (t.vehicle_messages, silver.VEHICLE_RULES)):
        envelopes = bronze.envelope_from_lines(_lines(messages))
        frames.append(silver.check_events(envelopes, rules).select(*silver.LINEAGE, "reject_reason"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _clean(messages: DataFrame, rules: silver.TopicRules) -> DataFrame:
    checked = silver.check_events(bronze.envelope_from_lines(_lines(messages)), rules)
    return silver.accepted(checked).drop("event")


def _refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to Silver with all tables written, then read back."""
    root = work_dir(spark, "refined")
    fleet = SampleFleet(spark, sf_dir)
    refine_bronze(spark, _all_envelopes(fleet).unionByName(bronze.envelope_from_lines(fleet.lost_lines)), root)
    counts = read_unrouted(spark, root).groupBy(F.col("reject_reason").alias("topic"))
    counts = counts.agg(F.lit(0).cast("long").alias("silver_rows"), F.count(F.lit(1)).alias("quarantine_rows"))
    for topic, rules in silver.RULES.items():
        good = read_silver(spark, root, topic).agg(F.count(F.lit(1)).alias("silver_rows"))
        bad = read_quarantine(spark, root, rules).agg(F.count(F.lit(1)).alias("quarantine_rows"))
        row = kpi.merge_rows(good, bad).select(F.lit(topic).alias("topic"), "silver_rows", "quarantine_rows")
        counts = counts.unionByName(row)
    return counts


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through the stream into Bronze, then read back."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "ingested")
    write_bronze(fleet.gps_messages(fleet.stream_events()), f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    stored = bronze.read_bronze(spark, f"{root}/bronze")
    vehicle = F.try_variant_get("event", "$.vehicle_id", "string").alias("vehicle_id")
    return stored.select("kafka_topic", "partition", "offset", vehicle, F.length("raw").alias("raw_length"))


def _in_batches(messages: DataFrame, path: str, batches: int) -> DataFrame:
    """Messages written to files of mixed times, as a stream of so many micro-batches. Each has a file per core, so that all of
    them parse and check it."""
    spark = messages.sparkSession
    cores = spark.sparkContext.defaultParallelism
    messages.repartition(batches * cores, F.crc32(F.col("offset").cast("string"))).write.parquet(path)
    return spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", cores).parquet(path)


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of mixed times through the stream, in six micro-batches, into clean positions, then read back."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "streamed")
    files = _in_batches(fleet.gps_messages(), f"{root}/messages", 6)
    envelopes = bronze.envelope_from_messages(files)
    write_silver(envelopes, silver.GPS_RULES, f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    return plain(_record(read_stream_silver(spark, f"{root}/silver", silver.GPS_RULES)).drop("_partition"))


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live positions after the stream has taken all messages."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "live")
    envelopes = bronze.envelope_from_messages(fleet.gps_messages(fleet.stream_events()))
    good = silver.accepted(silver.check_events(envelopes, silver.GPS_RULES))
    write_live(good, f"{root}/positions", f"{root}/checkpoint", availableNow=True).awaitTermination()
    return plain(read_live(spark, f"{root}/positions"))


def _stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed and rejected events of all topics, as their streams have counted them, in two micro-batches each."""
    fleet, root, counts = SampleFleet(spark, sf_dir), work_dir(spark, "counted"), None
    topics = (
        (silver.GPS_RULES, fleet.gps_messages()),
        (silver.DELIVERY_RULES, fleet.delivery_messages),
        (silver.VEHICLE_RULES, fleet.vehicle_messages),
    )
    for rules, messages in topics:
        source, target = f"{root}/messages/{rules.topic}", f"{root}/silver/{rules.topic}"
        files = _in_batches(messages, source, 2)
        stream = write_silver(bronze.envelope_from_messages(files), rules, target, f"{root}/checkpoint/{rules.topic}")
        stream.awaitTermination()
        found = read_stream_counts(spark, target, rules)
        counts = found if counts is None else counts.unionByName(found)
    return counts


def _all_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all topics through one stream into Bronze, then counted where they lie."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "topics")
    messages = fleet.gps_messages().unionByName(fleet.delivery_messages).unionByName(fleet.vehicle_messages)
    messages.write.parquet(f"{root}/messages")
    stream = spark.readStream.schema(messages.schema).parquet(f"{root}/messages")
    write_bronze(stream, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    stored = bronze.read_bronze(spark, f"{root}/bronze").groupBy("kafka_topic")
    return stored.agg(
        F.count(F.lit(1)).alias("messages"), F.count("raw").alias("unreadable"), F.max("offset").alias("last_offset")
    )


def _file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean positions written in track order over several files, and how many of those overlap."""
    path = f"{work_dir(spark, 'ordered')}/gps"
    good = silver.accepted(silver.check_events(_gps(SampleFleet(spark, sf_dir)), silver.GPS_RULES))
    silver.gps_record(silver.clean_tracks(good, parts=7)).write.parquet(path)
    ranges = silver.file_ranges(spark.read.parquet(path))
    figures = ranges.agg(
        F.sum("rows").alias("rows"), F.min("first.vehicle_id").alias("first_vehicle"), F.max("last.vehicle_id").alias("last_vehicle"),
        (F.count(F.lit(1)) > 1).alias("several_files"),
    )
    wrong = silver.overlapping_files(ranges).agg(F.count(F.lit(1)).alias("overlapping_files"))
    return kpi.merge_rows(figures, wrong)


def _copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables copied with reconciled counts, then counted where they arrived."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "copied")
    copy_tables(spark, fleet, root)
    return quality.row_counts({name: read_table(spark, root, name) for name in fleet})


def _laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions written as a warehouse fact, then counted per day from the folders they lie in."""
    root = work_dir(spark, "laid-out")
    write_table(SampleFleet(spark, sf_dir)["fact_gps"], f"{root}/fact_gps", "fact_gps")
    stored = read_table(spark, root, "fact_gps")
    day = F.date_format("event_date", "yyyy-MM-dd").alias("event_date")
    return stored.groupBy(day).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("vehicle_id").alias("vehicles"))


# What the rebuild is shown on: dimensions, one fact and a stored view of it.
REBUILT = ("dim_depot", "dim_vehicle", "dim_driver", "dim_route", "fact_gps")


def _rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables built, then rebuilt with a repeated depot, which must be refused and change nothing; then counted."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "rebuilt")
    tables = {**{name: fleet[name] for name in REBUILT}, "fact_trip": View("fact_gps", {"gps_key": "trip_key"})}
    rebuild_tables(spark, tables, root, BUSINESS_KEYS)
    twice = {**tables, "dim_depot": fleet["dim_depot"].unionByName(fleet["dim_depot"])}
    try:
        rebuild_tables(spark, twice, root, BUSINESS_KEYS)
        refused = False
    except LoadError:
        refused = True
    counts = None
    for name in tables:
        count = read_table(spark, root, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = count if counts is None else counts.unionByName(count)
    return counts.withColumn("refused", F.lit(refused))


# Sixty bits of the MD5 of a value's text, which any engine computes alike.
TEXT_HASH = "CAST(conv(substring(md5(CAST({} AS STRING)), 1, 15), 16, 10) AS BIGINT)"
# Columns whose text is the same in every engine.
PRINTED = {
    "dim_depot": ("depot_id", "depot_name", "city", "capacity"),
    "dim_vehicle": ("vehicle_id", "type", "model", "depot_id"),
    "dim_route": ("route_id", "destination"),
    "dim_date": ("date_key", "date", "quarter"),
    "fact_delivery": ("order_id", "vehicle_id", "status", "scan_status", "route_id", "location"),
    "fact_fuel": ("fuel_key", "vehicle_id", "fuel_type"),
    "fact_gps": ("gps_key", "vehicle_id"),
    "fact_maintenance": ("work_order_id", "issue", "priority"),
}


def _copy_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints of copied tables, column by column; the copy itself compares them with its source."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "prints")
    copy_tables(spark, {name: fleet[name] for name in PRINTED}, root)
    found = None
    for name, columns in PRINTED.items():
        rows = fingerprints(read_table(spark, root, name).select(*columns), TEXT_HASH, whole=False)
        rows = rows.select(F.lit(name).alias("table_name"), "column", "rows", "filled", F.col("fingerprint").cast("string").alias("fingerprint"))
        found = rows if found is None else found.unionByName(rows)
    return found


def _raw_file(spark: SparkSession, df: DataFrame, load) -> str:
    """A sample table as the raw file of a load, with another column before its own; returns the folder."""
    root, names = work_dir(spark, "raw"), dict(load.renamed)
    times = {f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    columns = [(_iso(c) if c in times else F.col(c)).alias(names.get(c, c)) for c in reversed(load.columns)]
    df.select(F.lit("x").alias("other"), *columns).write.option("header", True).csv(f"{root}/{load.file}")
    return root


def _loaded(table: str) -> Query:
    """A raw file of the table, loaded by header name."""
    load = next(load for load in LOADS if load.table == table)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _raw_file(spark, SampleFleet(spark, sf_dir)[table], load)
        return plain(load_csv(spark, root, load).drop(load.key))

    return run


def _csv_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work orders written as a raw file, then read and timed as the warehouse build does."""
    root = work_dir(spark, "raw")
    columns = ("work_order_id", "vehicle_id", "issue", "opened_at", "closed_at", "priority", "cost")
    rows = SampleFleet(spark, sf_dir)["fact_maintenance"].select(*[_iso(c) if c.endswith("_at") else F.col(c) for c in columns])
    rows.write.option("header", True).csv(f"{root}/maintenance.csv")
    return plain(read_maintenance(spark, root).drop("maintenance_key"))


def _planted_file(spark: SparkSession, sf_dir: str) -> str:
    """Positions as a raw file in which every seventh vehicle is cut by line breaks inside its quotes, every eleventh line has
    a value too many, every thirteenth a speed that is no number and every seventeenth no speed. The header stands before
    every line."""
    root = work_dir(spark, "planted")
    gps, key = SampleFleet(spark, sf_dir)["fact_gps"], F.col("gps_key")
    vehicle = F.col("vehicle_id").cast("string")
    vehicle = F.when(key % 7 == 0, F.concat(F.lit('"a\nb\n'), vehicle, F.lit('"'))).otherwise(vehicle)
    parts = [vehicle, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("1.5"), F.lit("2.5")]
    speed = F.when(key % 17 == 0, "").when(key % 13 == 0, ",fast").otherwise(F.concat(F.lit(","), F.col("speed").cast("string")))
    line = F.concat(F.concat_ws(",", *parts), speed, F.when(key % 11 == 0, ",more").otherwise(""))
    header = F.lit("vehicle_id,timestamp,latitude,longitude,speed\n")
    gps.select(F.concat(header, line)).write.text(f"{root}/gps.csv")
    return root


def _load_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a file of planted faults, the lines that were refused, and the rows that were loaded."""
    root = _planted_file(spark, sf_dir)
    load = next(load for load in LOADS if load.table == "fact_gps")
    path = f"{root}/{load.file}"
    found = faults(spark, path, kinds_of(load))
    refused = read_refused(spark, path, strict=True).groupBy(F.concat(F.lit("refused "), "fault").alias("fault"))
    loaded = load_csv(spark, root, load, strict=True).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("loaded").alias("fault"), "rows")
    return found.unionByName(refused.agg(F.count(F.lit(1)).alias("rows"))).unionByName(loaded)


def _view_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all ten published views, asked in SQL."""
    names = publish_kpis(SampleFleet(spark, sf_dir))
    return spark.sql(" UNION ALL ".join(f"SELECT '{name}' AS view_name, count(*) AS rows FROM {name}" for name in names))


def _silver_trails(t: SampleFleet) -> DataFrame:
    trail = latest.trails(_silver(t), tiebreak="_offset", min_points=2)
    points = trail.select("vehicle_id", F.posexplode("trail").alias("position", "point"))
    return points.select("vehicle_id", "position", "point.latitude", "point.longitude")


def _silver_with_vehicle(t: SampleFleet) -> DataFrame:
    vehicles = t["dim_vehicle"].withColumn("vehicle_id", F.concat(F.lit("V"), F.col("vehicle_id").cast("string")))
    return lookup.with_vehicle(silver.gps_record(latest.latest_silver(_silver(t))), vehicles)


def _iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss").alias(name)


def _csv_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles written as a raw file in another column order, then loaded by header name."""
    root = work_dir(spark, "raw")
    vehicles = SampleFleet(spark, sf_dir)["dim_vehicle"].withColumnRenamed("depot_id", "depot")
    columns = ["model", "vehicle_id", "depot", "fuel_capacity_liters", "type", "vehicle_key"]
    vehicles.select(*columns).write.option("header", True).csv(f"{root}/vehicles.csv")
    load = next(load for load in LOADS if load.table == "dim_vehicle")
    return load_csv(spark, root, load).drop("vehicle_key")


def _csv_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and scans written as raw files, then read, typed and looked up as the warehouse build does."""
    fleet, root = SampleFleet(spark, sf_dir), work_dir(spark, "raw")
    orders = fleet["fact_delivery"].select(*[_iso(c) if c == "promised_time" else F.col(c) for c in ORDER_COLUMNS])
    scans = fleet.scans.select(
        "location", F.col("scan_status").alias("status"), _iso("scan_time"), F.col("order_id")
    )
    orders.write.option("header", True).csv(f"{root}/orders.csv")
    scans.write.option("header", True).csv(f"{root}/delivery_scans.csv")
    return plain(attach_last_scan(read_orders(spark, root), read_scans(spark, root)))


def _trail_points(t: SampleFleet) -> DataFrame:
    trail = latest.trails(t["fact_gps"], tiebreak="gps_key", min_points=2)
    points = trail.select("vehicle_id", F.posexplode("trail").alias("position", "point"))
    return points.select("vehicle_id", "position", "point.latitude", "point.longitude")


def _features(t: SampleFleet) -> DataFrame:
    vector = vector_to_array("features")
    names = [vector[i].alias(f"feature_{i}") for i in range(len(ml.FEATURES))]
    return ml.assemble(t.trips_for_training).select("l_orderkey", "l_linenumber", *names)


KEY = ["l_orderkey", "l_linenumber"]


def _split(t: SampleFleet) -> DataFrame:
    training, test = ml.split(t.trips_for_training, KEY)
    return training.select(F.lit("train").alias("side"), *KEY).unionByName(test.select(F.lit("test").alias("side"), *KEY))


def _model_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cores = SampleFleet(spark, sf_dir).trips_for_training, spark.sparkContext.defaultParallelism
    return ml.train_and_save(rows, KEY, work_dir(spark, "fuel-model"), partitions=cores)


def _scored(t: SampleFleet) -> DataFrame:
    rows, cores = t.trips_for_training, t.spark.sparkContext.defaultParallelism
    training, _ = ml.split(rows, KEY)
    return ml.score(ml.train(training, partitions=cores, spread_by=KEY), rows)


def queries() -> dict[str, Query]:
    positions = ("vehicle_id", "timestamp", "latitude", "longitude", "speed")
    return {
        # Tables
        "row_counts": _over(quality.row_counts),
        "warehouse_copy": _copied,
        "warehouse_layout": _laid_out,
        "warehouse_rebuild": _rebuilt,
        "copy_fingerprints": _copy_fingerprints,
        "csv_vehicles": _csv_vehicles,
        "csv_deliveries": _csv_deliveries,
        "csv_depots": _loaded("dim_depot"),
        "csv_drivers": _loaded("dim_driver"),
        "csv_routes": _loaded("dim_route"),
        "csv_customers": _loaded("dim_customer"),
        "csv_fuel": _loaded("fact_fuel"),
        "csv_gps": _loaded("fact_gps"),
        "csv_telemetry": _loaded("fact_vehicle_telemetry"),
        "csv_maintenance": _csv_maintenance,
        "load_faults": _load_faults,
        "dim_depot": _over(lambda t: t["dim_depot"]),
        "dim_date": _over(lambda t: t["dim_date"]),
        "fact_delivery": _over(lambda t: t["fact_delivery"].drop("delivery_key")),
        "fact_maintenance": _over(lambda t: t["fact_maintenance"].drop("maintenance_key")),
        "fact_trip": _over(lambda t: trips_from_gps(t["fact_gps"])),
        "duplicate_work_orders": _over(lambda t: quality.duplicate_keys(t["fact_maintenance"], "work_order_id")),
        # Governed KPIs
        "delivery_trend": _view("vw_delivery_trend"),
        "fuel_efficiency": _view("vw_fuel_efficiency"),
        "cost_per_delivery": _view("vw_cost_per_delivery"),
        "idle_time": _view("vw_idle_time"),
        "maintenance_kpi": _view("vw_maintenance_kpi"),
        "route_performance": _view("vw_route_performance"),
        "vehicle_kpi": _view("vw_vehicle_kpi"),
        "depot_performance": _view("vw_depot_performance"),
        "executive_kpis": _view("vw_executive_kpis"),
        "exceptions": _view("vw_exceptions"),
        "published_views": _published,
        "published_rows": _view_rows,
        # Ranked reports
        "first_trend_days": _over(lambda t: reports.first_days(_trend(t))),
        "worst_routes": _over(lambda t: reports.worst_routes(_routes(t))),
        "busiest_vehicles": _over(lambda t: reports.busiest_vehicles(kpi_view(t, "vw_vehicle_kpi"))),
        "depot_ranking": _over(lambda t: reports.depot_ranking(kpi_view(t, "vw_depot_performance"))),
        "top_exceptions": _over(lambda t: reports.top_exceptions(kpi_view(t, "vw_exceptions"))),
        "recent_fuel": _over(lambda t: reports.recent_fuel(t["fact_fuel"])),
        "recent_maintenance": _over(lambda t: reports.recent_maintenance(t["fact_maintenance"])),
        # Dashboard
        "dashboard_summary": _over(lambda t: serving.dashboard_summary(*_headline(t))),
        "delivery_performance": _over(lambda t: serving.delivery_performance(t["fact_delivery"])),
        "fuel_by_type": _over(lambda t: serving.fuel_by_type(t["fact_fuel"])),
        "maintenance_by_priority": _over(lambda t: serving.maintenance_by_priority(t["fact_maintenance"])),
        "fleet_status": _over(lambda t: serving.fleet_status(t["fact_gps"])),
        "bounding_box": _over(lambda t: serving.bounding_box(latest.latest_row(t["fact_gps"], [F.col("gps_key").desc()]))),
        "alert_counters": _over(lambda t: serving.alert_counters(_silver(t), t["fact_gps"], t["fact_delivery"])),
        "overspeed_alerts": _over(lambda t: serving.overspeed_alerts(t["fact_gps"], [F.col("gps_key")])),
        "overspeed_positions": _over(lambda t: t["fact_gps"].where(overspeed("speed"))),
        "motion_status": _over(
            lambda t: t["fact_gps"].select(
                "gps_key", motion_status("speed").alias("status"), popup_status("speed").alias("popup_status")
            )
        ),
        "route_list": _over(lambda t: lookup.route_list(t["dim_route"])),
        "route_page": _over(lambda t: serving.shown_first(lookup.route_list(t["dim_route"]), ROUTE_PAGE, "route_key")),
        # Choosing one route is what this list does.
        "route_filter": _over(lambda t: serving.filter_routes(lookup.route_list(t["dim_route"]), ONE_ROUTE)),
        "fuel_page": _over(lambda t: reports.recent_fuel(t["fact_fuel"], FUEL_PAGE)),
        "maintenance_page": _over(lambda t: reports.recent_maintenance(t["fact_maintenance"], MAINTENANCE_PAGE)),
        # Newest rows per vehicle
        "latest_position": _over(lambda t: latest.latest_row(t["fact_gps"], [F.col("gps_key").desc()])),
        "latest_position_ties": _over(lambda t: latest.latest_ties(t["fact_gps"])),
        "live_fleet": _over(lambda t: latest.live_fleet(t["dim_vehicle"], t["fact_gps"])),
        "idle_fleet": _over(
            lambda t: serving.filter_fleet(latest.live_fleet(t["dim_vehicle"], t["fact_gps"]), status="Idle")
        ),
        "fleet_page": _over(
            lambda t: serving.shown_first(
                serving.filter_fleet(latest.live_fleet(t["dim_vehicle"], t["fact_gps"])), FLEET_PAGE, "vehicle_id", "speed"
            )
        ),
        "latest_with_vehicle": _over(
            lambda t: lookup.with_vehicle(
                latest.latest_row(t["fact_gps"], [F.col("gps_key").desc()]).select(*positions), t["dim_vehicle"]
            )
        ),
        "trail_points": _over(_trail_points),
        # Quality
        "row_checks": _over(quality.row_checks),
        "uniqueness_checks": _over(quality.uniqueness_checks),
        "reference_checks": _over(quality.reference_checks),
        "all_checks": _over(quality.all_checks),
        "health_summary": _over(
            lambda t: quality.health_summary(
                t["dim_vehicle"], t["fact_gps"], t["fact_delivery"], t["fact_fuel"], t["fact_maintenance"]
            ).withColumn("failed_checks", F.array_join("failed_checks", ","))
        ),
        "unknown_gps_routes": _over(
            lambda t: lookup.orphan_keys(t["fact_gps"], t["dim_route"], "vehicle_id", "route_id")
        ),
        # Events, batch
        "silver_gps": _over(lambda t: _record(_silver(t))),
        "silver_delivery": _over(lambda t: _clean(t.delivery_messages, silver.DELIVERY_RULES)),
        "silver_vehicle": _over(lambda t: _clean(t.vehicle_messages, silver.VEHICLE_RULES)),
        "silver_page": _over(
            lambda t: serving.shown_first(silver.gps_record(_silver(t)), SILVER_PAGE, "vehicle_id", "timestamp")
        ),
        "silver_latest": _over(lambda t: silver.gps_record(latest.latest_silver(_silver(t)))),
        "silver_overspeed": _over(lambda t: serving.overspeed_alerts(silver.gps_record(_silver(t)), [F.col("vehicle_id"), F.col("timestamp")])),
        "silver_trails": _over(_silver_trails),
        "silver_box": _over(lambda t: serving.bounding_box(latest.latest_silver(_silver(t)))),
        "silver_with_vehicle": _over(_silver_with_vehicle),
        "silver_file_order": _file_order,
        "topic_counts": _over(lambda t: silver.topic_counts(_checked(t))),
        "reject_counts": _over(lambda t: silver.reject_counts(_checked(t))),
        "refined_tables": _refined,
        # Events, streamed
        "bronze_ingest": _ingested,
        "bronze_topics": _all_topics,
        "silver_stream": _streamed,
        "stream_counts": _stream_counts,
        "live_stream": _live,
        # Fuel model
        "model_features": _over(_features),
        "model_split": _over(_split),
        "model_error": _model_error,
        "model_scores": _over(_scored),
    }
