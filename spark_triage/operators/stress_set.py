"""The evaluation set: a stratified part plus planted hard cases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import text as tx
from spark_triage.operators.profile import union_all
from spark_triage.operators.sampling import hash_key, lowest, stratified_sample
from spark_triage.session import broadcast_up_to, staged


@dataclass(frozen=True)
class StressPlan:
    stratified: int = fv.STRATIFIED_ROWS
    per_category: int = fv.HARD_PER_CATEGORY
    hard_total: int = fv.HARD_TOTAL
    low_pool: int = fv.LOW_SIMILARITY_POOL
    high_similarity: float = fv.HIGH_SIMILARITY_STRESS
    stratify_seed: int = fv.STRATIFY_SEED
    hard_seed: int = fv.HARD_SEED


def sampling_pool(
    rows: DataFrame, similarity: DataFrame, id_col: str, text_col: str,
    fraud_patterns=fv.FRAUD_PATTERNS, vocab_patterns=fv.PAY_FOR_PATTERNS,
) -> DataFrame:
    """Held-out rows with the features the selection needs. ``similarity`` is (id, max_similarity); a row without one
    stays in the pool, is no near copy and comes last by similarity."""
    return rows.join(similarity, id_col, "left").withColumns(
        {
            "fraud_override": tx.fraud_override(F.col(text_col), fraud_patterns),
            "pay_for_match": tx.vocab_overlap(F.col(text_col), vocab_patterns),
        }
    )


def select_stress_set(pool: DataFrame, id_col: str, intent: str, plan: StressPlan = StressPlan()) -> DataFrame:
    """Pool rows tagged ``hard_case_category`` ('' for the stratified part).

    Categories are filled in order without replacement. A category can lose at most the rows taken before
    it, so its first ``hard_total`` rows are enough; with the lowest-similarity pool that bounds the
    candidates to a few hundred rows, on which the taking is a chain of window steps. The pool is scanned
    several times: give it as a table, or stage it.
    """
    stratified = staged(stratified_sample(pool, intent, id_col, plan.stratified, plan.stratify_seed), "stratified")
    rest = pool.join(broadcast_up_to(stratified.select(id_col), plan.stratified), id_col, "left_anti").withColumn(
        "_key", hash_key(id_col, plan.hard_seed)
    )
    named = {
        "fraud_keyword": F.col("fraud_override"),
        "near_verbatim_stress": F.col("max_similarity") > plan.high_similarity,
        "pay_for_vocab_overlap": F.col("pay_for_match"),
    }
    need = max(plan.hard_total, plan.per_category * (len(named) + 1))
    member = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in named.items()]))
    in_category = Window.partitionBy("_category").orderBy("_key", id_col)
    picked = (
        rest.withColumn("_category", F.explode(member))
        .withColumn("_r", F.row_number().over(in_category)).filter(F.col("_r") <= need)
        .drop("_category", "_r")
    )
    low = lowest(rest, "max_similarity", id_col, plan.low_pool + plan.hard_total)
    candidates = picked.unionByName(low).dropDuplicates([id_col])  # a few hundred rows from here on

    by_similarity = Window.orderBy(F.col("max_similarity").asc_nulls_last(), id_col)
    frame = candidates.withColumn("_low", F.row_number().over(by_similarity)).withColumn(
        "_taken", F.lit(None).cast("string")
    )

    def take(df: DataFrame, cond: Column, label: str, target: Column) -> DataFrame:
        free = cond & F.col("_taken").isNull()
        df = df.withColumn("_free", free)
        place = F.row_number().over(Window.partitionBy("_free").orderBy("_key", id_col))
        return df.withColumn("_place", place).withColumn(
            "_taken", F.when(F.col("_free") & (F.col("_place") <= target), F.lit(label)).otherwise(F.col("_taken"))
        )

    per = F.lit(plan.per_category)
    for name, cond in named.items():
        frame = take(frame, cond, name, per)
    frame = take(frame, F.col("_low") <= plan.low_pool, "low_retrieval_similarity", per)
    short = F.greatest(F.lit(plan.hard_total) - F.count("_taken").over(Window.partitionBy()), F.lit(0))
    frame = frame.withColumn("_short", short)
    frame = take(frame, F.col("_low") <= F.lit(plan.low_pool) + F.col("_short"), "low_retrieval_similarity_backfill", F.col("_short"))

    hard = frame.filter(F.col("_taken").isNotNull()).withColumn("hard_case_category", F.col("_taken"))
    columns = [*pool.columns, "hard_case_category"]
    return union_all([stratified.withColumn("hard_case_category", F.lit("")).select(columns), hard.select(columns)])
