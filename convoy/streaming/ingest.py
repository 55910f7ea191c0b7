"""Messages of all topics into the Bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from convoy.sources.bronze import envelope_from_messages


def write_bronze(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append envelopes, one folder per topic. Offsets live in the checkpoint, so a restart neither loses nor repeats.

    The trigger defaults to taking everything there is and stopping.
    """
    return (
        envelope_from_messages(messages)
        .writeStream.partitionBy("kafka_topic")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
