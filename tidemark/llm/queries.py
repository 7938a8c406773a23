"""The named queries of this subpackage: each operator on its whole table with its usual parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import oracles
from tidemark.llm.alignment import align_digests, score_links
from tidemark.llm.classifier import classify_quality
from tidemark.llm.common import read
from tidemark.llm.decontamination import find_contamination
from tidemark.llm.language import identify_languages
from tidemark.llm.licenses import known_notices, scan_licenses
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dedup import near_classes
from tidemark.llm.negatives import mine_negatives, scaled_vectors
from tidemark.llm.privacy import find_personal_data
from tidemark.llm.quality import quality_rules
from tidemark.llm.scoring import labelled_target, score_documents
from tidemark.llm.substrings import remove_repeats
from tidemark.llm.urls import filter_urls


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "is_first")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"), known_notices(spark))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_documents(docs, labelled_target(docs, read(spark, sf_dir, "labels")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = scaled_vectors(read(spark, sf_dir, "embeddings").withColumn("label", turned))
    return mine_negatives(vectors, F.col("id") % 50 == 0)


def tokenizer_file(name: str) -> str:
    """A file of the public tokenizers, which are installed on every machine; ``TOKENIZERS`` names another folder."""
    return os.path.join(os.environ.get("TOKENIZERS", "/opt/tokenizers"), name)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return score_links(align_digests(read(spark, sf_dir, "documents"), *files))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_source_mixing, op3_language_id, op4_benchmark_decontamination, op5_quality_rules,
        op6_personal_data, op7_near_dedup, op8_url_filters, op9_license_scans, op10_lm_scoring,
        op11_hard_negatives, op12_tokenizer_alignment, op13_quality_classifier,
    )
}

SQL: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op2_source_mixing": oracles.SOURCE_MIXING,
    "op5_quality_rules": oracles.QUALITY_RULES,
    "op9_license_scans": oracles.LICENSE_SCANS,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
}
