"""Corpus preparation as stages over ``documents``; each takes what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymark.llm import byte_bpe, decontaminate, jaccard, pii, quality
from tallymark.llm.common import durable, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, trained on the labels of these documents, does not reject.

    Null and empty texts score by the bias alone; ids play no part but in the choice of the sample, so
    rows without one are scored too; repeated rows stay or go together; texts of any length are scored whole.
    """
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, weights)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share shingles as the Jaccard join asks, directly or through others, the smallest id.

    Null and blank texts link with nothing and stay; a row without an id stays where no linked row has
    one; rows that repeat id and text stay or go together; texts of any length are compared whole.
    """
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item, whatever their ids; null and empty texts hold none and stay.

    Repeated rows stay or go together, very long texts are searched whole, other columns pass through.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data in their texts replaced by its kind; null stays null, whatever the id or length."""
    cleaned = pii.redacted(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else cleaned


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: number of tokens, digest of the ids, digest of the text decoded from them; null counts as empty."""
    return byte_bpe.encoding_digests(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", decontaminated),
    ("pii", without_personal_data),
    ("byte_bpe", encoded),
]

# Training and byte-pair merging have no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
