"""The registered queries of the pipeline operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_triage.llm import (
    counts, decompose, idfiles, maxsketch, neardup, packing, pii, quality, repair, sharding, substring, topk, wordtable)
from spark_triage.llm import tokens as tk
from spark_triage.llm.common import load
from spark_triage.llm.sql import SQL

__all__ = ["QUERIES", "SQL", "vocabulary"]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return tk.read_vocabulary(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents")).drop("host_rejected")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(load(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.without_repeats(load(spark, sf_dir, "documents")))


def op4_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordtable.encoded(load(spark, sf_dir, "documents"), vocabulary(), digest=True)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(load(spark, sf_dir, "documents"))


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.round_trip(load(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), vocabulary())


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(load(spark, sf_dir, "documents"), vocabulary())


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(load(spark, sf_dir, "documents")).drop("all_spans")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxsketch.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_digest(load(spark, sf_dir, "conversations"))


def op13_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decompose.digest(decompose.sequences(load(spark, sf_dir, "documents"), vocabulary()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_word_table": op4_word_table,
    "op5_sharding": op5_sharding,
    "op6_id_files": op6_id_files,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_token_counts": op8_token_counts,
    "op9_personal_data": op9_personal_data,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_max_sketch_search": op11_max_sketch_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_power_of_two_packing": op13_power_of_two_packing,
}
