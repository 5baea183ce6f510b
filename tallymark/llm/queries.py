"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import audit, byte_bpe, chat, decontaminate, jaccard, language, pii, quality, resampling, rules, substrings, token_counts, warc
from .common import table


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    weights = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, weights).select(
        "doc_id",
        (quality.fold(F.col("doc_id")) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents")).drop("fp")


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_substrings(table(spark, folder, "documents")).drop("kept")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents"))


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(turns.unionByName(extra))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encoding_digests(table(spark, folder, "documents"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_digests(table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    files = warc.archive_pages(table(spark, folder, "pages"))
    return warc.read_records(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("fp")


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.predicted(docs, language.learn(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_pii": op8_pii,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_filter_audit": op12_filter_audit,
    "op13_language_id": op13_language_id,
}
