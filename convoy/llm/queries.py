"""A query for every operator of this folder, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from convoy.llm import (
    ann,
    bpe,
    decontaminate,
    langid,
    licenses,
    line_dedup,
    ranked_search,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    warc,
    whitening,
)
from convoy.llm.common import held_out, table

#: From which score a document counts as toxic.
TOXIC = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~held_out(3, 1)))
    scored = docs.select("doc_id", held_out(3, 1).alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("t"))
    score = F.col("t.score")
    return scored.select(
        "doc_id", "held_out", score.alias("score"), (score >= TOXIC).cast("int").alias("predicted"), "t.hits", "t.words"
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licenses(F.col("text"))
    scanned = table(spark, sf_dir, "documents").select("doc_id", found.alias("found"))
    best = F.get("found", F.lit(0))
    return scanned.select(
        "doc_id",
        best["license"].alias("license"),
        best["dice"].alias("dice"),
        F.size("found").cast("long").alias("n_licenses"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    number = lambda c: F.regexp_extract(c, r"urn:page:(-?\d+)", 1).try_cast("long")
    return warc.read_records(archives).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Encode and decode ``docs``, and digest both results."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeats(docs).select(
        "doc_id",
        F.col("dedup.n_lines").cast("long").alias("n_lines"),
        F.col("dedup.n_removed").cast("long").alias("n_removed"),
        F.sha2("dedup.kept", 256).alias("kept_sha256"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~held_out(4, 2)))
    guessed = docs.select("doc_id", held_out(4, 2).alias("held_out"), langid.language(F.col("text"), model).alias("guess"))
    return guessed.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"),
        F.col("n_words").cast("long"),
        F.col("n_hit").cast("long"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = ann.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = substring_dedup.remove_repeats(docs)
    return cleaned.select(
        "doc_id",
        F.col("dedup.n_words").cast("long").alias("n_words"),
        F.col("dedup.n_removed").cast("long").alias("n_removed"),
        F.sha2("dedup.kept", 256).alias("kept_sha256"),
    )


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = whitening.grid(table(spark, sf_dir, "embeddings"))
    model = whitening.fit(points, components=32)
    error = whitening.identity_error(points, model)
    return whitening.whiten(points, model).select(
        F.col("id").alias("vec_id"),
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )


OPERATORS = (
    op1_toxicity,
    op2_licenses,
    op3_warc,
    op4_bpe,
    op5_simhash,
    op6_line_dedup,
    op7_language,
    op8_decontamination,
    op9_neighbours,
    op10_substring_dedup,
    op11_sharding,
    op12_ranked_search,
    op13_whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}
