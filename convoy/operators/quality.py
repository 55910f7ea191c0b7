"""Data-quality checks: volume, completeness, ranges, uniqueness and references."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.predicates import is_blank
from convoy.operators.kpi import merge_rows
from convoy.schemas import TABLES

# The checks, each as table and column or rule.
REQUIRED = (
    ("dim_vehicle", "vehicle_id"),
    ("dim_driver", "driver_id"),
    ("dim_route", "route_id"),
    ("dim_customer", "customer_id"),
    ("fact_delivery", "order_id"),
    ("fact_fuel", "vehicle_id"),
    ("fact_maintenance", "work_order_id"),
    ("fact_gps", "vehicle_id"),
)
UNIQUE = (
    ("dim_vehicle", "vehicle_id"),
    ("dim_driver", "driver_id"),
    ("dim_route", "route_id"),
    ("dim_customer", "customer_id"),
    ("fact_delivery", "order_id"),
    ("fact_maintenance", "work_order_id"),
)
REFERENCES = (
    ("delivery -> vehicle", "fact_delivery", "dim_vehicle", "vehicle_id"),
    ("delivery -> driver", "fact_delivery", "dim_driver", "driver_id"),
    ("delivery -> route", "fact_delivery", "dim_route", "route_id"),
    ("delivery -> customer", "fact_delivery", "dim_customer", "customer_id"),
    ("fuel -> vehicle", "fact_fuel", "dim_vehicle", "vehicle_id"),
    ("maintenance -> vehicle", "fact_maintenance", "dim_vehicle", "vehicle_id"),
    ("gps -> vehicle", "fact_gps", "dim_vehicle", "vehicle_id"),
)
# A rule holds where the row is wrong. NULL is not wrong.
RANGES = (
    ("GPS latitude", "fact_gps", "latitude < -90 OR latitude > 90"),
    ("GPS longitude", "fact_gps", "longitude < -180 OR longitude > 180"),
    ("GPS speed", "fact_gps", "speed < 0"),
    ("Fuel liters", "fact_fuel", "liters <= 0"),
    ("Fuel amount", "fact_fuel", "amount < 0"),
    ("Telemetry fuel %", "fact_vehicle_telemetry", "fuel_level_percent < 0 OR fuel_level_percent > 100"),
    ("Telemetry remaining fuel", "fact_vehicle_telemetry", "remaining_fuel_liters < 0"),
    ("Maintenance cost", "fact_maintenance", "cost < 0"),
    ("Maintenance downtime", "fact_maintenance", "downtime_hours < 0"),
)
TOP_SPEED = 200

Tables = Mapping[str, DataFrame]


def _result(family: str, name: str, value: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(family).alias("check_family"),
        F.lit(name).alias("check_name"),
        value.alias("value"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def _row_counters(families: tuple[str, ...]) -> dict[str, list[tuple[str, str, Column]]]:
    counters: dict[str, list[tuple[str, str, Column]]] = defaultdict(list)
    if "volume" in families:
        for table in TABLES:
            counters[table].append(("volume", table, F.count(F.lit(1))))
    if "completeness" in families:
        for table, column in REQUIRED:
            counters[table].append(("completeness", f"{table}.{column}", F.count_if(is_blank(column))))
    if "range" in families:
        for name, table, rule in RANGES:
            counters[table].append(("range", name, F.count_if(F.expr(rule))))
    return counters


def row_checks(tables: Tables, families: tuple[str, ...] = ("volume", "completeness", "range")) -> DataFrame:
    """Checks that look at one row at a time: a single pass per table counts all of them."""
    frames = []
    for table, checks in _row_counters(families).items():
        counted = tables[table].agg(*[counter.alias(f"_{i}") for i, (_, _, counter) in enumerate(checks)])
        results = [
            _result(family, name, F.col(f"_{i}"), F.col(f"_{i}") > 0 if family == "volume" else F.col(f"_{i}") == 0)
            for i, (family, name, _) in enumerate(checks)
        ]
        frames.append(counted.select(F.inline(F.array(*results))))
    return _union(frames)


def row_counts(tables: Tables) -> DataFrame:
    """Rows of every table."""
    return _union(
        [tables[t].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows") for t in TABLES]
    )


def key_groups(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return key_groups(df, key).where(F.col("rows") > 1)


def bad_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that break a load: NULL, empty or repeated."""
    return key_groups(df, key).where(is_blank("key") | (F.col("rows") > 1))


def _all() -> list[tuple[str, str]]:
    """Every check as family and name, in the order in which they are numbered below."""
    return [
        *(("volume", table) for table in TABLES),
        *(("completeness", f"{table}.{column}") for table, column in REQUIRED),
        *(("range", name) for name, _, _ in RANGES),
        *(("uniqueness", f"{table}.{column}") for table, column in UNIQUE),
        *(("reference", name) for name, *_ in REFERENCES),
    ]


def _pairs(df: DataFrame, table: str, families: tuple[str, ...]) -> DataFrame | None:
    """What every row of a table has to say, as (check, key, rows, known).

    A row counts once for its volume, for each rule it breaks, and under its key for each key that must be unique or known. A
    dimension marks its keys as known to the checks that look them up; no row refers to a NULL there.
    """
    number = {check: i for i, check in enumerate(_all())}

    def pair(family: str, name: str, key: Column | None = None, rows: int = 1, known: bool = False) -> Column:
        key = F.lit(None) if key is None else key
        parts = (F.lit(number[family, name]), key.cast("string"), F.lit(rows).cast("bigint"), F.lit(known))
        return F.struct(*[part.alias(c) for part, c in zip(parts, ("check", "key", "rows", "known"))])

    said = {
        "volume": [pair("volume", table)],
        "completeness": [F.when(is_blank(c), pair("completeness", f"{t}.{c}")) for t, c in REQUIRED if t == table],
        "range": [F.when(F.expr(rule), pair("range", name)) for name, t, rule in RANGES if t == table],
        "uniqueness": [pair("uniqueness", f"{t}.{c}", F.col(c)) for t, c in UNIQUE if t == table],
        "reference": [pair("reference", name, F.col(key)) for name, fact, _, key in REFERENCES if fact == table]
        + [
            F.when(F.col(key).isNotNull(), pair("reference", name, F.col(key), 0, True))
            for name, _, dimension, key in REFERENCES
            if dimension == table
        ],
    }
    pairs = [p for family in families for p in said[family]]
    return df.select(F.inline(F.array_compact(F.array(*pairs)))) if pairs else None


def _counted(tables: Tables, families: tuple[str, ...]) -> DataFrame:
    """The checks of some families as (check_family, check_name, value, status, duplicate_keys).

    All tables go through one aggregate over (check, key) pairs: each is read once, rows shrink to one per check and key before
    the only shuffle that carries keys, and facts meet their dimensions there without a join. Uniqueness checks alone don't
    shrink rows before it. The second shuffle carries a row per check and partition. Every check starts from a pair of its own with no rows, so that none is missing.
    """
    checks = _all()
    wanted = [i for i, (family, _) in enumerate(checks) if family in families]
    spark = next(iter(tables.values())).sparkSession
    start = spark.range(len(checks)).where(F.col("id").isin(wanted))
    none = (F.lit(None).cast("string").alias("key"), F.lit(0).cast("bigint").alias("rows"), F.lit(False).alias("known"))
    frames = [start.select(F.col("id").cast("int").alias("check"), *none)]
    frames += [pairs for pairs in (_pairs(tables[t], t, families) for t in TABLES) if pairs is not None]
    pairs = _union(frames)
    if families == ("uniqueness",):
        # Most keys are unique: to combine them before the shuffle would fill a map with every row of a task and spare nothing.
        # With their number given, Spark keeps all partitions, so that tasks stay small however few cores there are.
        pairs = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "check", "key")
    groups = pairs.groupBy("check", "key").agg(F.sum("rows").alias("rows"), F.max("known").alias("known"))
    family = F.element_at(F.array(*[F.lit(f) for f, _ in checks]), F.col("check") + 1)
    name = F.element_at(F.array(*[F.lit(n) for _, n in checks]), F.col("check") + 1)
    counted = (
        F.when(family == "reference", F.when(F.col("known"), 0).otherwise(F.col("rows")))
        .when((family == "uniqueness") & F.col("key").isNotNull(), F.col("rows") - 1)
        .otherwise(F.col("rows"))
    )
    values = groups.groupBy("check").agg(F.sum(counted).alias("value"), F.count_if(F.col("rows") > 1).alias("duplicate_keys"))
    passed = F.when(family == "volume", F.col("value") > 0).otherwise(F.col("value") == 0)
    return values.select(
        family.alias("check_family"),
        name.alias("check_name"),
        "value",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        "duplicate_keys",
    )


def uniqueness_checks(tables: Tables) -> DataFrame:
    """Rows in excess of the distinct keys. A NULL key counts as excess; keys that repeat are counted beside it."""
    return _counted(tables, ("uniqueness",))


def reference_checks(tables: Tables) -> DataFrame:
    """Fact rows without their dimension row. A NULL key is never known. Both sides must hold keys of one type."""
    return _counted(tables, ("reference",)).drop("duplicate_keys")


def all_checks(tables: Tables) -> DataFrame:
    """All 42 checks in one table, with each of the 12 tables read once."""
    return _counted(tables, ("volume", "completeness", "range", "uniqueness", "reference")).drop("duplicate_keys")


def health_summary(
    vehicles: DataFrame, gps: DataFrame, deliveries: DataFrame, fuel: DataFrame, maintenance: DataFrame
) -> DataFrame:
    """One row: eight figures, the checks that failed and the overall status."""
    known = key_groups(vehicles, "vehicle_id")
    seen = gps.groupBy(F.col("vehicle_id").alias("key")).agg(
        F.count(F.lit(1)).alias("_positions"),
        F.count_if((F.col("speed") < 0) | (F.col("speed") > TOP_SPEED)).alias("_bad_speed"),
    )

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    figures = merge_rows(
        known.agg(
            total(F.col("rows")).alias("vehicle_count"),
            total(F.when(F.col("key").isNull(), F.col("rows"))).alias("null_vehicle_ids"),
            F.count_if(F.col("rows") > 1).alias("duplicate_vehicle_ids"),
        ),
        seen.join(known, "key", "left").agg(
            total(F.when(F.col("rows").isNull(), F.col("_positions"))).alias("invalid_gps_vehicle_references"),
            total(F.col("_bad_speed")).alias("invalid_gps_speed"),
        ),
        deliveries.agg(F.count(F.lit(1)).alias("delivery_count")),
        fuel.agg(F.count(F.lit(1)).alias("fuel_count")),
        maintenance.agg(F.count(F.lit(1)).alias("maintenance_count")),
    )
    filled = ("vehicle_count", "delivery_count", "fuel_count", "maintenance_count")
    failures = [
        F.when((F.col(name) == 0) if name in filled else (F.col(name) > 0), F.lit(name))
        for name in (
            "vehicle_count",
            "null_vehicle_ids",
            "duplicate_vehicle_ids",
            "invalid_gps_vehicle_references",
            "invalid_gps_speed",
            "delivery_count",
            "fuel_count",
            "maintenance_count",
        )
    ]
    failed = F.array_compact(F.array(*failures))
    return figures.withColumn("failed_checks", failed).withColumn(
        "status", F.when(F.size("failed_checks") == 0, "healthy").otherwise("warning")
    )
