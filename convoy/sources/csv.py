"""Raw CSV files: columns are found by header name, typed on the way in.

Files are read line by line, so that a large one is split over tasks. A line break inside a quoted value would then make two
rows of one: such lines don't close their quotes, and are refused and counted, as are lines with too many values. Loads of
small files may allow line breaks instead.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions.temporal import iso_timestamp
from convoy.schemas import table_schema
from convoy.sources import files


@dataclass(frozen=True)
class CsvLoad:
    """One file and the table it fills; ``renamed`` maps a table column to a file column of another name.

    ``line_breaks`` allows them inside quoted values, at the price of a task for every file, however large.
    """

    file: str
    table: str
    columns: tuple[str, ...]
    renamed: tuple[tuple[str, str], ...] = ()
    key: str | None = None
    line_breaks: bool = False


# Files and their columns.
LOADS = (
    CsvLoad("depots.csv", "dim_depot", ("depot_id", "depot_name", "city", "capacity"), key="depot_key", line_breaks=True),
    CsvLoad(
        "vehicles.csv",
        "dim_vehicle",
        ("vehicle_id", "type", "depot_id", "capacity", "model", "fuel_capacity_liters"),
        (("depot_id", "depot"),),
        "vehicle_key",
        line_breaks=True,
    ),
    CsvLoad(
        "drivers.csv",
        "dim_driver",
        ("driver_id", "name", "depot_id", "experience_years", "shift"),
        (("depot_id", "depot"),),
        "driver_key",
        line_breaks=True,
    ),
    CsvLoad(
        "routes.csv",
        "dim_route",
        ("route_id", "origin", "destination", "distance_km", "expected_duration_min"),
        key="route_key",
        line_breaks=True,
    ),
    CsvLoad("customers.csv", "dim_customer", ("customer_id", "customer_name", "city", "service_area"), key="customer_key"),
    CsvLoad(
        "fuel.csv",
        "fact_fuel",
        ("vehicle_id", "timestamp", "liters", "amount", "fuel_type", "odometer_km"),
        key="fuel_key",
    ),
    CsvLoad("gps.csv", "fact_gps", ("vehicle_id", "timestamp", "latitude", "longitude", "speed"), key="gps_key"),
    CsvLoad(
        "vehicle_telemetry.csv",
        "fact_vehicle_telemetry",
        ("vehicle_id", "timestamp", "engine_status", "fuel_level_percent", "remaining_fuel_liters", "odometer_km"),
        key="telemetry_key",
    ),
)


#: What may be wrong with a line: quotes that don't close, more values than the header has, or fewer.
OPEN_QUOTE, TOO_LONG, SHORT = "open_quote", "too_long", "short"


def checked_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines but empty ones and the header, with their values as text, ``_line`` itself and ``_fault``, NULL for none.

    Every file of a folder may repeat the header. Quotes are doubled inside quoted values; a short line ends in NULLs.
    """
    lines = spark.read.text(path)
    header = files.first_line(spark, path) or ""
    if not header.strip():  # compressed, or not beginning with the header
        first = lines.where(F.trim("value") != "").head(1)
        header = first[0]["value"] if first else ""
    names = next(csv.reader([header.lstrip("\ufeff")]), [])
    width = "length(_bare) - length(replace(_bare, ',', '')) + 1"
    fault = (
        f"CASE WHEN _quotes % 2 != 0 THEN '{OPEN_QUOTE}' WHEN {width} > {len(names)} THEN '{TOO_LONG}' "
        f"WHEN {width} < {len(names)} THEN '{SHORT}' END AS _fault"
    )
    # numbered inside, as names may be anything
    schema = ", ".join(f"c{i} string" for i in range(max(len(names), 1)))
    parsed = f"from_csv(_line, '{schema}', map('escape', '\"', 'mode', 'PERMISSIVE')) AS _values"
    values = [f"_values.c{i} AS `{name.replace('`', '``')}`" for i, name in enumerate(names)]
    return (
        lines.where((F.trim("value") != "") & (F.col("value") != F.lit(header)))
        .selectExpr("value AS _line", "length(value) - length(replace(value, '\"', '')) AS _quotes")
        .selectExpr("_line", "_quotes", "if(_quotes > 0, regexp_replace(_line, '\"[^\"]*\"', ''), _line) AS _bare")
        .selectExpr("_line", fault, parsed)
        .selectExpr(*values, "_line", "_fault")
    )


def refused(strict: bool = False) -> Column:
    """Whether a checked line is no row. Short lines are rows, unless ``strict``."""
    bad = ", ".join(f"'{fault}'" for fault in (OPEN_QUOTE, TOO_LONG, *([SHORT] if strict else [])))
    return F.expr(f"coalesce(_fault IN ({bad}), false)")


def read_csv(spark: SparkSession, path: str, line_breaks: bool = False, strict: bool = False) -> DataFrame:
    """All columns as text, without the lines that are refused.

    With ``line_breaks`` a task reads a whole file and nothing is refused. ``strict`` is for files in which a quote stays open
    somewhere: what lies between two such lines looks like short ones.
    """
    if line_breaks:
        reader = spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
        return reader.option("multiLine", True).csv(path)
    return checked_lines(spark, path).where(~refused(strict)).drop("_line", "_fault")


def read_refused(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """The refused lines of a file, as (line, fault)."""
    lines = checked_lines(spark, path).where(refused(strict))
    return lines.select(F.col("_line").alias("line"), F.col("_fault").alias("fault"))


def faults(spark: SparkSession, path: str, kinds: Mapping[str, str], line_breaks: bool = False) -> DataFrame:
    """What is wrong with a file, as (fault, rows), in one pass: faulty lines, and per column the texts that can't be read.

    ``kinds`` gives the type of each column that is not text.
    """
    raw = read_csv(spark, path, line_breaks=True) if line_breaks else checked_lines(spark, path)
    known = {name: column_of(raw, name) for name in kinds}
    counted = {
        f"unreadable {name}": (F.trim(text) != "") & typed(text, kinds[name]).isNull() for name, text in known.items()
    }
    if not line_breaks:
        readable = ~refused()
        counted = {name: readable & wrong for name, wrong in counted.items()}
        counted |= {fault: F.col("_fault") == fault for fault in (OPEN_QUOTE, TOO_LONG, SHORT)}
    if not counted:
        return spark.createDataFrame([], "fault string, rows long")
    totals = raw.agg(*[F.count_if(wrong).alias(f"_{i}") for i, wrong in enumerate(counted.values())])
    rows = [F.struct(F.lit(name).alias("fault"), F.col(f"_{i}").alias("rows")) for i, name in enumerate(counted)]
    return totals.select(F.inline(F.array(*rows)))


def column_of(df: DataFrame, name: str) -> Column:
    """The file's column, or NULLs where the file has no such column."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def typed(value: Column, kind: str) -> Column:
    """Text as the given type; empty or unreadable text is NULL. A number with a fraction is no whole number."""
    if kind == "string":
        return value
    if kind == "timestamp":
        return iso_timestamp(value)
    text = F.nullif(F.trim(value), F.lit(""))
    if kind == "double":
        return text.try_cast(kind)
    wide = text.try_cast("decimal(38,10)")  # for 12.0 and 1e3
    return F.coalesce(text.try_cast(kind), F.when(wide == F.floor(wide), wide.try_cast(kind)))


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Surrogate key in scan order: unique and ascending, with gaps between input partitions."""
    return df.select(F.monotonically_increasing_id().alias(key), "*")


def kinds_of(load: CsvLoad) -> dict[str, str]:
    """The file columns of a load that are not text, with their types."""
    kinds, names = {f.name: f.dataType.simpleString() for f in table_schema(load.table)}, dict(load.renamed)
    return {names.get(c, c): kinds[c] for c in load.columns if kinds[c] != "string"}


def _columns(raw: DataFrame, load: CsvLoad) -> tuple[dict[str, Column], dict[str, Column]]:
    """For every column of the table its text in the file and its value."""
    kinds = {f.name: f.dataType.simpleString() for f in table_schema(load.table)}
    names = dict(load.renamed)
    texts = {c: column_of(raw, names.get(c, c)) for c in load.columns}
    return texts, {c: typed(text, kinds[c]) for c, text in texts.items()}


def load_csv(spark: SparkSession, raw_dir: str, load: CsvLoad, strict: bool = False) -> DataFrame:
    raw = read_csv(spark, f"{raw_dir}/{load.file}", load.line_breaks, strict)
    _, values = _columns(raw, load)
    rows = raw.select(*[value.alias(c) for c, value in values.items()])
    return with_key(rows, load.key) if load.key else rows


def unreadable(spark: SparkSession, raw_dir: str, load: CsvLoad) -> DataFrame:
    """For every column of a load, how many texts that are not empty were read as NULL."""
    raw = read_csv(spark, f"{raw_dir}/{load.file}", load.line_breaks)
    texts, values = _columns(raw, load)
    lost = [F.count_if((F.trim(texts[c]) != "") & values[c].isNull()).alias(c) for c in texts]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("values")) for c in texts]))
    return raw.agg(*lost).select(F.lit(load.table).alias("table"), pairs.alias("p")).select("table", "p.column", "p.values")
