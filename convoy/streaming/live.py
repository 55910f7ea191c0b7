"""Newest position of every vehicle, kept up to date."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from convoy.functions.predicates import motion_status, overspeed
from convoy.operators.latest import first_rows
from convoy.sources import manifest

REFRESH = "10 seconds"
# Batches between two snapshots; an hour at the usual refresh.
SNAPSHOT_EVERY = 360


def live_positions(positions: DataFrame) -> DataFrame:
    """The newest position per vehicle with its status and overspeed flag; of equal times the lowest offset wins.

    The maximum is merged within each input partition before the shuffle, and the state is one row per vehicle.
    """
    newest = F.max(F.struct("timestamp", (-F.col("_offset")).alias("_order"), "latitude", "longitude", "speed"))
    return (
        positions.groupBy("vehicle_id")
        .agg(newest.alias("_newest"))
        .select(
            "vehicle_id",
            "_newest.timestamp",
            "_newest.latitude",
            "_newest.longitude",
            "_newest.speed",
            motion_status(F.col("_newest.speed")).alias("status"),
            F.coalesce(overspeed(F.col("_newest.speed")), F.lit(False)).alias("overspeed"),
        )
    )


def write_live(
    positions: DataFrame,
    path: str,
    checkpoint: str,
    snapshot_every: int = SNAPSHOT_EVERY,
    retain: int = manifest.RETAIN,
    **trigger,
) -> StreamingQuery:
    """Write the vehicles that moved in each micro-batch, and all of them once there are ``snapshot_every`` such changes.

    The table's log names the last snapshot and the changes after it, one commit a batch; a batch committed before a restart
    is passed over. Folders that a snapshot replaces are removed ``retain`` commits later.
    """

    def save(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        number, state = manifest.newest(spark, path)
        if batch <= state.get("last", -1):
            return
        folder = f"changes/batch={batch}-{uuid.uuid4().hex[:12]}"
        changed.withColumn("_batch", F.lit(batch).cast("long")).write.parquet(f"{path}/{folder}")
        state = {**state, "last": batch, "schema": changed.schema.json(), "changes": [*state.get("changes", []), folder]}
        number = manifest.commit(spark, path, number, _live(state), retain=retain)
        if len(state["changes"]) >= snapshot_every:
            _snapshot(spark, path, number, retain)

    return (
        live_positions(positions)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(**(trigger or {"processingTime": REFRESH}))
        .start()
    )


def _live(state: dict) -> dict:
    return {**state, "folders": [*([state["snapshot"]] if state.get("snapshot") else []), *state["changes"]]}


def _snapshot(spark: SparkSession, path: str, number: int, retain: int) -> None:
    """Write the current position of every vehicle and let the log name it in place of what it was made from."""
    _, state = manifest.newest(spark, path)
    folder = f"snapshots/batch={state['last']}-{uuid.uuid4().hex[:12]}"
    current = read_live(spark, path).withColumn("_batch", F.lit(state["last"]).cast("long"))
    current.write.parquet(f"{path}/{folder}")
    manifest.commit(spark, path, number, _live({**state, "snapshot": folder, "changes": []}), state["folders"], retain)
    for below in ("changes", "snapshots"):
        manifest.sweep(spark, path, below)


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """The current position of every vehicle, from its last change. Fails if nothing was written yet."""
    _, state = manifest.newest(spark, path)
    schema = T.StructType.fromJson(json.loads(state["schema"])).add("_batch", T.LongType())
    stored = spark.read.schema(schema).parquet(*[f"{path}/{folder}" for folder in state["folders"]])
    return first_rows(stored, ["vehicle_id"], [F.col("_batch").desc()]).drop("_batch")
