"""Bronze to Silver as a batch, for all topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy.operators.silver import (
    GPS_RULES,
    RULES,
    TopicRules,
    accepted,
    check_events,
    clean_tracks,
    rejected,
    topic_counts,
)
from convoy.sources.bronze import ENVELOPE


def refine_topic(spark: SparkSession, envelopes: DataFrame, rules: TopicRules, root: str) -> None:
    """Check the events once, keep the outcome of every one, and derive the clean table from the good ones.

    Good and bad events land in two partitions of one table, so the JSON is parsed a single time and the quarantine
    needs no further copy.
    """
    checked = check_events(envelopes, rules).withColumn("accepted", F.col("reject_reason").isNull())
    checked.write.mode("overwrite").partitionBy("accepted").parquet(f"{root}/checked/{rules.topic}")
    good = accepted(read_checked(spark, root, rules).where("accepted")).drop("accepted")
    if rules.topic == GPS_RULES.topic:
        good = clean_tracks(good)
    good.write.mode("overwrite").parquet(f"{root}/silver/{rules.topic}")


def _checked_schema(spark: SparkSession, rules: TopicRules) -> T.StructType:
    """Columns of the checked table. A topic without events leaves no file to read them from."""
    columns = check_events(spark.createDataFrame([], ENVELOPE), rules).schema
    return T.StructType(columns.fields).add("accepted", T.BooleanType())


def read_checked(spark: SparkSession, root: str, rules: TopicRules) -> DataFrame:
    return spark.read.schema(_checked_schema(spark, rules)).parquet(f"{root}/checked/{rules.topic}")


def read_silver(spark: SparkSession, root: str, topic: str) -> DataFrame:
    return spark.read.parquet(f"{root}/silver/{topic}")


def read_quarantine(spark: SparkSession, root: str, rules: TopicRules) -> DataFrame:
    return rejected(read_checked(spark, root, rules).where("NOT accepted"))


def unrouted(envelopes: DataFrame) -> DataFrame:
    """Envelopes of no topic that has rules, with the reason: malformed_json, missing_topic or unknown_topic."""
    topic = F.col("kafka_topic")
    nameless = F.when(F.try_parse_json("raw").isNull() & F.col("event").isNull(), "malformed_json").otherwise("missing_topic")
    lost = envelopes.where(topic.isNull() | ~topic.isin(*RULES))
    return lost.withColumn("reject_reason", F.when(topic.isNull(), nameless).otherwise("unknown_topic"))


def read_unrouted(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{ENVELOPE}, reject_reason string").parquet(f"{root}/unrouted")


def refine_bronze(spark: SparkSession, envelopes: DataFrame, root: str) -> DataFrame:
    """Refine every topic below root and return the processed and rejected counts.

    Every envelope has one outcome. Those of no known topic are kept apart with their reason and counted under it, so that
    rows in = clean rows + repeated positions + quarantine + these.
    """
    unrouted(envelopes).write.mode("overwrite").parquet(f"{root}/unrouted")
    lost = read_unrouted(spark, root).groupBy(F.col("reject_reason").alias("topic"))
    counts = lost.agg(F.lit(0).cast("long").alias("processed"), F.count(F.lit(1)).alias("rejected"))
    for topic, rules in RULES.items():
        refine_topic(spark, envelopes.where(F.col("kafka_topic") == topic), rules, root)
        counts = counts.unionByName(topic_counts(read_checked(spark, root, rules)))
    return counts
