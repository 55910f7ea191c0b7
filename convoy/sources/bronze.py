"""Raw events: Kafka topics, JSON lines and the Bronze table, all as the same envelope.

An envelope has the columns kafka_topic, partition, offset, event (VARIANT, any fields) and raw, which keeps the text
where no event could be read from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.schemas import TOPICS

ENVELOPE = "partition int, offset bigint, event variant, raw string, kafka_topic string"
MESSAGE = "topic string, partition int, offset bigint, value string"


def kafka_messages(
    spark: SparkSession, servers: str, topics: tuple[str, ...] = TOPICS, per_trigger: int | None = None
) -> DataFrame:
    """Stream of all topics from their start. Needs Spark's Kafka package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def _parsed(text: str) -> Column:
    """The text as a VARIANT, NULL where it is no JSON. Exploding an array of one keeps later filters above the parsing."""
    return F.explode(F.array(F.try_parse_json(text)))


def envelope_from_messages(messages: DataFrame) -> DataFrame:
    """Add the message's place in its topic to the event."""
    return messages.select("*", _parsed("value").alias("event")).select(
        "partition",
        "offset",
        "event",
        F.when(F.col("event").isNull(), F.col("value")).alias("raw"),
        F.col("topic").alias("kafka_topic"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def envelope_from_lines(lines: DataFrame) -> DataFrame:
    """Envelopes from JSON lines that already carry topic, partition and offset. Blank lines are skipped."""
    parsed = lines.where(F.trim("value") != "").select("value", _parsed("value").alias("_line"))

    def part(path: str, kind: str) -> Column:
        return F.try_variant_get("_line", path, kind)

    return parsed.select(
        part("$.partition", "int").alias("partition"),
        part("$.offset", "bigint").alias("offset"),
        part("$.event", "variant").alias("event"),
        F.when(part("$.event", "variant").isNull(), F.col("value")).alias("raw"),
        part("$.kafka_topic", "string").alias("kafka_topic"),
    )


def read_bronze(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """The Bronze table; a topic is one partition, so other topics are not read."""
    bronze = spark.read.schema(ENVELOPE).parquet(path)
    return bronze if topic is None else bronze.where(F.col("kafka_topic") == topic)


def stream_bronze(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    bronze = spark.readStream.schema(ENVELOPE).parquet(path)
    return bronze if topic is None else bronze.where(F.col("kafka_topic") == topic)
