"""A training corpus from `documents`: each stage is one operator, written and read again by the next.

Defined cases are those of the operators: null texts count as empty, repeated rows and rows without id
are told apart by their texts, ties go to the smallest id, texts of any length are read whole, empty
tables give empty results, and all stages but the last keep the caller's columns, whatever their names.
A table without labels or benchmark items rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filinglake.llm import decontaminate, near_dedup, packing, sanitise, toxicity
from filinglake.llm.common import discard, land, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sanitise_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms replaced in their texts."""
    return sanitise.sanitised(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in token sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sanitise", sanitise_texts),
    ("packing", pack_sequences),
]

# Trained models and signatures have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; every stage reads what the one before has written.

    What a stage has written is deleted when the next one is written, but for the last: the result reads it.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, land(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if hasattr(before, "landed"):
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
