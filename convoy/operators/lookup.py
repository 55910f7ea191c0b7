"""Lookups and integrity joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.operators.latest import first_rows


def last_scans(scans: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """The last scan of every order by scan time; the remaining columns decide between equal times."""
    rest = tiebreak if tiebreak is not None else [c for c in scans.columns if c not in ("order_id", "scan_time")]
    order = [F.col("scan_time").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest]]
    return first_rows(scans, ["order_id"], order)


def attach_last_scan(orders: DataFrame, scans: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Orders with the columns of their last scan. Text columns of an order never scanned are empty, not NULL."""
    last = last_scans(scans, tiebreak)
    texts = {name for name, kind in scans.dtypes if kind == "string" and name in ("scan_status", "location")}
    found = orders.join(last, "order_id", "left")
    return found.withColumns({name: F.coalesce(name, F.lit("")) for name in sorted(texts)})


def orphan_keys(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Keys of the facts that the dimension lacks, with their row counts. NULL keys are orphans too.

    Facts shrink to one row per key before they meet the dimension: the shuffle carries keys, not rows, and a hot key
    costs no more than any other.
    """
    counted = facts.groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    known = dimension.select(F.col(dimension_key).alias("key"))
    return counted.join(known, "key", "left_anti")


def orphan_count(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """One row with the number of fact rows that have no dimension row."""
    missing = orphan_keys(facts, dimension, fact_key, dimension_key)
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphans"))


def with_vehicle(positions: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Positions with type and model of their vehicle, where known."""
    return positions.join(vehicles.select("vehicle_id", "type", "model"), "vehicle_id", "left")


def route_list(routes: DataFrame) -> DataFrame:
    """All routes in key order."""
    return routes.select(
        "route_key", "route_id", "origin", "destination", "distance_km", "expected_duration_min"
    ).orderBy("route_key")
