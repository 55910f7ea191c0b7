"""The corpus pipeline: one stage after another, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.llm import decontaminate, line_dedup, simhash, toxicity
from convoy.llm.common import fresh, held_out, table
from convoy.llm.queries import TOXIC, bpe_digests
from convoy.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold. The lexicon is learned from labelled ones that are not held out."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out(3, 1)))
    scored = fresh(docs, "toxicity")
    kept = docs.withColumn(scored, toxicity.toxicity(F.col("text"), model))
    return kept.where(F.col(scored)["score"] < TOXIC).drop(scored)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat in windows of three; ``n_chars`` follows the text."""
    cleaned, dedup = line_dedup.remove_repeats(docs), fresh(docs, "dedup")
    cleaned = cleaned.withColumn("text", F.col(dedup)["kept"])
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a window of a benchmark item."""
    hits = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0")
    names = [fresh(docs, "hit_id"), fresh(docs, "hit_hash")]
    hits = hits.select(F.col("id").alias(names[0]), F.col("text_hash").alias(names[1]))
    same = docs["doc_id"].eqNullSafe(hits[names[0]]) & (F.xxhash64(docs["text"]) == hits[names[1]])
    return docs.join(hits, same, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, as digests."""
    return bpe_digests(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]
# Learned models, XXH64 and BPE have no SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. What each one keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
