"""Batch hand-off to a model: prompts out, responses in, one stricter retry, dead letters."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import prompts as pr
from spark_triage.functions import responses as rs


def score_prompts(prompts: DataFrame, scorer: Callable[[list[str]], list[str]], attempt: int = 1) -> DataFrame:
    """(id, attempt, raw) from the caller's scorer, batch by batch in the tasks that hold the prompts."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "attempt": attempt, "raw": scorer(pdf["prompt"].tolist())})

    return prompts.select("id", "prompt").mapInPandas(run, "id bigint, attempt int, raw string")


def classification_round(responses: DataFrame, intents=fv.INTENTS) -> DataFrame:
    """Responses of one or two attempts to one row per id: (id, intent, confidence, outcome, attempts).

    outcome: ``ok``; ``retry`` when only a first, unusable answer is there; ``dead`` when the second is
    unusable too or a confidence was no number. Rows do not depend on each other.
    """
    parsed = responses.select("id", "attempt", rs.parse_classification(F.col("raw"), intents).alias("p"))
    first = F.min_by("p", F.when(F.col("attempt") == 1, F.lit(1)))
    second = F.min_by("p", F.when(F.col("attempt") == 2, F.lit(1)))
    both = parsed.groupBy("id").agg(first.alias("a"), second.alias("b"))
    used = F.when(F.col("a.status") == "retry", F.col("b")).otherwise(F.col("a"))
    return both.withColumn("u", used).select(
        "id",
        F.col("u.intent").alias("intent"),
        F.col("u.confidence").alias("confidence"),
        F.when(F.col("u").isNull(), F.lit("retry")).when(F.col("u.status") == "ok", F.lit("ok"))
        .otherwise(F.lit("dead")).alias("outcome"),
        F.when((F.col("a.status") == "retry") & F.col("b").isNotNull(), F.lit(2)).otherwise(F.lit(1)).alias("attempts"),
    )


def retry_prompts(prompts: DataFrame, rounds: DataFrame, suffix: str = fv.CLASSIFY_RETRY) -> DataFrame:
    """The stricter prompt for every id whose first answer was unusable."""
    todo = rounds.filter(F.col("outcome") == "retry").select("id")
    return prompts.join(todo, "id", "left_semi").withColumn("prompt", pr.retry_prompt(F.col("prompt"), suffix))


def judge_round(responses: DataFrame) -> DataFrame:
    """(id, attempt, valid, <dim>_score, <dim>_rationale..) of judge answers: the first valid attempt, or an
    invalid row when none is."""
    parsed = responses.select("id", "attempt", rs.parse_judge(F.col("raw")).alias("p"))
    best = F.min_by(
        F.struct("attempt", "p"),
        F.col("attempt") + F.when(F.col("p.valid"), F.lit(0)).otherwise(F.lit(1000)),
    )
    return parsed.groupBy("id").agg(best.alias("x")).select("id", "x.attempt", "x.p.*")


def judge_outcomes(responses: DataFrame) -> DataFrame:
    """(id, outcome): ``ok``; ``retry`` when only a first, invalid answer is there; ``dead`` when the second is
    invalid too."""
    tried = responses.groupBy("id").agg(F.max("attempt").alias("attempts"))
    return judge_round(responses).select("id", "valid").join(tried, "id").select(
        "id", F.when(F.col("valid"), F.lit("ok")).when(F.col("attempts") == 1, F.lit("retry")).otherwise(F.lit("dead"))
        .alias("outcome"))


def response_health(parsed: DataFrame, status: Column) -> DataFrame:
    """Calls per attempt and status."""
    return parsed.groupBy("attempt", status.alias("status")).agg(F.count("*").alias("n"))


def draft_routing(rows: DataFrame, override: str = "fraud_override") -> DataFrame:
    """Where each message goes: overridden ones get the fixed message, no retrieval and no prompt."""
    flags = F.array().cast("array<struct<kind:string,detail:string,score:double>>")
    return rows.withColumns(
        {
            "route": F.when(F.col(override), F.lit("holding")).otherwise(F.lit("draft")),
            "drafted_reply": F.when(F.col(override), F.lit(fv.HOLDING_MESSAGE)),
            "retrieval_top1_similarity": F.when(F.col(override), F.lit(0.0)),
            "validate_draft_flags": F.when(F.col(override), flags),
        }
    )
