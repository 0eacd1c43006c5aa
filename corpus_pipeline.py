"""Corpus pipeline: language, repeated lines, near copies, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before it
kept; all but the last return the columns of ``documents``. Each result is written and
read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm import language_id, line_dedup, near_dup, packing, pii
from presswork.llm.common import unused

LEAST_SCORE = 0.5  # of the predicted language


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; it learns from those with a language.

    Texts that are null or without letters go, and those without a likely language.
    """
    likely = language_id.predicted(spark, F.col("text"), language_id.learn(docs))
    found = unused(docs, "language")
    kept = (F.col(found)["lang"] != language_id.UNKNOWN) & (F.col(found)["score"] >= LEAST_SCORE)
    return docs.withColumn(found, likely).filter(kept).select(docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least ten documents hold go; an emptied document stays as empty text."""
    return line_dedup.dedup_lines(docs, counts=False).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return near_dup.keep_one(docs).select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact_pii(docs).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", repeated_lines),
    ("near_dup", one_of_each),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: The language model and the tokenizer have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
