"""Newest rows per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.functions.predicates import is_blank

TRAIL_POINTS = 15


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of every key.

    Spark keeps at most n rows per key in each input partition before it shuffles, so a key with a third of all rows
    sends only n rows per partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= n).drop("_place")


def latest_row(df: DataFrame, tiebreak: list[Column], key: str = "vehicle_id", at: str = "timestamp") -> DataFrame:
    """Exactly one newest row per key. Rows without a time come last, not first."""
    return first_rows(df, [key], [F.col(at).desc_nulls_last(), *tiebreak])


def latest_ties(df: DataFrame, key: str = "vehicle_id", at: str = "timestamp") -> DataFrame:
    """All rows that carry the newest time of their key; rows without key or time never match.

    The result may hold any number of copies of one row, so no task may own a whole key. Each input partition first
    drops what is not newest in it, then the survivors join the newest time per key. The salt is the number of the input
    partition, which a rerun task computes again unchanged, so there are as many groups of a key as partitions hold it.
    """
    known = df.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    newest = known.groupBy(key).agg(F.max(at).alias(at))
    spread = Window.partitionBy(key, "_spread").orderBy(F.col(at).desc())
    survivors = (
        known.withColumn("_spread", F.spark_partition_id())
        .withColumn("_rank", F.rank().over(spread))
        .where(F.col("_rank") == 1)
        .drop("_rank", "_spread")
    )
    return survivors.join(newest, [key, at]).select(*df.columns)


def live_fleet(vehicles: DataFrame, gps: DataFrame) -> DataFrame:
    """Newest positions with vehicle attributes; vehicles without a position are absent."""
    positions = latest_ties(gps.select("vehicle_id", "timestamp", "latitude", "longitude", "speed"))
    return (
        vehicles.select("vehicle_id", "type", "model", "depot_id")
        .join(positions, "vehicle_id")
        .select("vehicle_id", "type", "model", "depot_id", "timestamp", "latitude", "longitude", "speed")
        .orderBy("vehicle_id")
    )


def latest_silver(gps: DataFrame) -> DataFrame:
    """Newest clean position per vehicle; of equal times the one read first wins."""
    return latest_row(gps, [F.col("_offset").asc(), F.col("_partition").asc()])


def trails(
    gps: DataFrame,
    tiebreak: str = "_offset",
    points: int = TRAIL_POINTS,
    min_points: int = 1,
) -> DataFrame:
    """The last points of every vehicle in time order, as an array of (latitude, longitude)."""
    valid = reduce(
        lambda a, b: a & b,
        [F.col("latitude").isNotNull(), F.col("longitude").isNotNull(), ~is_blank("vehicle_id")],
    )
    slim = gps.where(valid).select("vehicle_id", "timestamp", F.col(tiebreak).alias("_seq"), "latitude", "longitude")
    recent = first_rows(
        slim, ["vehicle_id"], [F.col("timestamp").desc_nulls_last(), F.col("_seq").desc()], points
    )
    # At most `points` rows per vehicle are left here, so the arrays are bounded.
    ordered = F.array_sort(F.collect_list(F.struct("timestamp", "_seq", "latitude", "longitude")))
    return (
        recent.groupBy("vehicle_id")
        .agg(ordered.alias("_points"))
        .select(
            "vehicle_id",
            F.transform("_points", lambda p: F.struct(p.latitude.alias("latitude"), p.longitude.alias("longitude"))).alias(
                "trail"
            ),
        )
        .where(F.size("trail") >= min_points)
    )
