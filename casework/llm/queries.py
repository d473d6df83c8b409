"""The corpus queries: each numbered operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casework.llm import (
    fingerprints,
    licences,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    sharding,
    suffix_dedup,
    toxicity,
    turn_repair,
    url_filter,
    vector_codes,
    vector_dedup,
)
from casework.llm.common import read_table


def vocabulary() -> str:
    """The public byte-level vocabulary file installed beside the tokenizer libraries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, folder, "documents"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), vocabulary())


def op3_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.class_report(read_table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op5_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(read_table(spark, folder, "documents"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    labels = url_filter.page_labels(read_table(spark, folder, "labels"))
    return url_filter.judge(read_table(spark, folder, "pages"), labels)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, folder, "documents"))


def op8_pivot_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.vector_classes(read_table(spark, folder, "embeddings"))


def op9_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, folder, "documents"))


def op10_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read_table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_report(read_table(spark, folder, "conversations"))


def op12_orchard_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(read_table(spark, folder, "embeddings"))


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeat_report(read_table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_mix_sources,
        op2_best_fit_packing,
        op3_order_minhash,
        op4_toxicity,
        op5_licence_scan,
        op6_url_filter,
        op7_line_dedup,
        op8_pivot_dedup,
        op9_merkle_fingerprints,
        op10_hilbert_shards,
        op11_conversation_repair,
        op12_orchard_codes,
        op13_suffix_dedup,
        pipeline,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_licence_scan": licences.licences_sql(), "op12_orchard_codes": vector_codes.vector_codes_sql()}
