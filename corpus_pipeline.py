"""From raw documents to training sequences: toxicity, near duplicates, benchmark leaks, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medallion.llm.decontaminate import drop_leaks
from medallion.llm.jaccard import keep_one_of_each
from medallion.llm.packing import pack_documents
from medallion.llm.pii import mask_text
from medallion.llm.queries import PSEUDONYM_KEY
from medallion.llm.tables import load, stored
from medallion.llm.toxicity import reject_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go."""
    return reject_toxic(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingle similarity the first stays."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced."""
    return mask_text(docs, PSEUDONYM_KEY, counted=None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("packing", packing),
]

# Trained scores, edit distances and tokenization have no SQL form; stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
