"""Result tables: method comparison, judge calibration, failure listings, policy study."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import prompts as pm
from spark_triage.operators import evaluate as ev
from spark_triage.operators import failures as fl
from spark_triage.operators import inference as inf
from spark_triage.operators import profile as pf
from spark_triage.operators import retrieval as rt
from spark_triage.operators import sampling as sm
from spark_triage.session import staged
from spark_triage.sources.tables import remaining


def baselines(golden: DataFrame, pseudo: DataFrame, simple_intent: str, high_risk=fv.HIGH_RISK_INTENTS) -> dict[str, DataFrame]:
    compared = ev.compare_methods(ev.method_rows(golden, pseudo, simple_intent, high_risk))
    return {"metrics": compared, "lines": ev.comparison_lines(compared)}


def judge_prompts(golden: DataFrame, done: DataFrame | None = None) -> DataFrame:
    todo = golden if done is None else remaining(golden, done, "customer_tweet_id")
    return todo.select(
        F.col("customer_tweet_id").alias("id"), pm.judge_prompt(F.col("tweet_text"), F.col("drafted_reply")).alias("prompt")
    )


def judge_retry_prompts(golden: DataFrame, responses: DataFrame) -> DataFrame:
    """The stricter judge prompt for every row whose first answer was invalid."""
    return inf.retry_prompts(judge_prompts(golden), inf.judge_outcomes(responses), fv.JUDGE_RETRY)


def judge_dead_letters(golden: DataFrame, responses: DataFrame) -> DataFrame:
    """(customer_tweet_id, reason) of rows without scores: ``dead``, ``retry``, or ``missing`` without an answer."""
    outcomes = inf.judge_outcomes(responses).withColumnRenamed("id", "customer_tweet_id")
    return golden.select("customer_tweet_id").join(outcomes, "customer_tweet_id", "left").select(
        "customer_tweet_id", F.coalesce("outcome", F.lit("missing")).alias("reason")).filter("reason <> 'ok'")


def judge_scores(responses: DataFrame) -> DataFrame:
    return inf.judge_round(responses).filter("valid").drop("valid", "attempt").withColumnRenamed("id", "customer_tweet_id")


def human_sample(golden: DataFrame, n: int = fv.HUMAN_SAMPLE_ROWS, seed: int = fv.HUMAN_SAMPLE_SEED) -> DataFrame:
    filled = golden.withColumn("hard_case_category", F.coalesce("hard_case_category", F.lit("")))
    return ev.scoring_template(sm.stratified_sample(filled, "hard_case_category", "customer_tweet_id", n, seed))


def calibration(human: DataFrame, judge: DataFrame) -> dict[str, DataFrame]:
    """Refuses blank human scores, then agreement per dimension."""
    ev.require_scores(human)
    agreement = ev.judge_agreement(ev.score_pairs(human, judge, "customer_tweet_id"))
    return {"agreement": agreement, "lines": ev.agreement_lines(agreement)}


def failures(golden: DataFrame, judge: DataFrame) -> DataFrame:
    return fl.failure_candidates(fl.golden_with_scores(golden, judge))


def threshold_study(
    pseudo: DataFrame, corpus: DataFrame, corpus_id: str, n: int = fv.SIMILARITY_STUDY_ROWS,
    seed: int = fv.SIMILARITY_STUDY_SEED, vector: str = "embedding",
) -> DataFrame:
    """Confidence of all pseudo-labels and top-1 similarity of a seeded sample, as (score, point, value)."""
    sample = sm.seeded_sample(pseudo, "customer_tweet_id", seed, n)
    best = staged(rt.max_similarity(sample, corpus, "customer_tweet_id", corpus_id, vector=vector), "similarity")
    return pf.union_all([pf.score_profile(pseudo, ["confidence"]), pf.score_profile(best, ["max_similarity"])])
