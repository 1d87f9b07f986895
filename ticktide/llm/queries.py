"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktide.llm import (alignment, byte_bpe, dialogue, fingerprints, langid, packing, pii, quality, sentencepiece,
                          simhash, substring_dedup, token_counts, url_filter)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that comes back from them, as digests."""
    back = sentencepiece.decode(sentencepiece.encode(table(spark, sf_dir, "documents")))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                       F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("text_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed passages of every text, the documents that keep them, and a digest of what is kept."""
    found = substring_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_spans", "n_removed", "spans", "firsts",
                        F.sha2("text", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes that come back from them, as digests."""
    back = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_sentencepiece, op2_token_counts, op3_substring_dedup, op4_quality,
    op5_pii, op6_language, op7_fingerprints, op8_url_filter, op9_packing, op10_simhash,
    op11_byte_bpe, op12_alignment, op13_dialogue)}

ORACLES: dict[str, str] = {"op8_url_filter": url_filter.judge_sql()}
