"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Toxic documents go, later copies of repeated line runs go, one document of each
near-duplicate class stays, sources are mixed to their target weights, and the
mix is packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casework.llm import line_dedup, mixing, near_dedup, packing, toxicity
from casework.llm.common import read_table, stage
from casework.llm.queries import vocabulary


def reject_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return toxicity.accepted(docs, read_table(spark, folder, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return line_dedup.deduped(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return near_dedup.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned scores, alignment and tokens have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The packed pieces of what every stage keeps of ``documents``."""
    docs = read_table(spark, folder, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, folder), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, folder)
