"""A corpus from raw documents to a mix of training data: five stages, each on what the one before has kept.

Every stage takes an empty table for an empty one, and leaves columns that it
does not know as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import read, write_through
from tidemark.llm.decontamination import drop_contaminated
from tidemark.llm.language import keep_known_languages
from tidemark.llm.mixing import mix_corpus
from tidemark.llm.near_dedup import drop_near_duplicates
from tidemark.llm.privacy import redact


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the labelled ones teach.

    Null and empty texts, and those without a letter, have no language and go.
    Equal rows are judged alike and all stay or go. Without labels nothing stays.
    """
    return keep_known_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, the one of least id.

    Equal rows are one document; null ids come after all others. Texts without a
    word are in no class and stay.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no item of the benchmark.

    Null and empty texts hold none; null and empty items are in no text. Equal
    rows all stay or go.
    """
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with personal data replaced by its kind.

    Null texts stay null. Of spans that overlap the one that begins first is
    replaced. Equal rows stay equal.
    """
    return redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training corpus: texts cut or repeated as the mix of the sources takes them, and ``taken``, their words.

    Documents of which the mix takes nothing go, and so do null and empty texts.
    A null source is a source; equal rows are one, taken together.
    """
    return mix_corpus(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
]

#: SQL cannot express the first four stages; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return docs
