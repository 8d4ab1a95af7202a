"""Failure listings over golden rows joined with judge scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage.session import broadcast_up_to, staged

ID = "customer_tweet_id"


def golden_with_scores(golden: DataFrame, judge: DataFrame) -> DataFrame:
    return golden.join(judge, ID, "left")


def differs(a: str, b: str) -> Column:
    """Inequality where a missing value counts as different, even from another missing one."""
    return F.coalesce(F.col(a) != F.col(b), F.lit(True))


def _low(score: str) -> Column:
    return F.coalesce(F.col(score) <= 2, F.lit(False))


def is_misclassified() -> Column:
    return differs("true_intent", "predicted_intent")


def is_missed() -> Column:
    return (F.col("true_escalation_decision") == "escalate") & (F.col("escalation_decision") == "auto")


def is_over_escalated() -> Column:
    return (F.col("true_escalation_decision") == "auto") & (F.col("escalation_decision") == "escalate")


def is_failed_hard_case() -> Column:
    planted = F.coalesce(F.col("hard_case_category"), F.lit("")) != ""
    return planted & (is_misclassified() | differs("true_escalation_decision", "escalation_decision"))


def is_low_grounding() -> Column:
    return _low("groundedness_score") | _low("no_hallucinated_specifics_score")


def is_flagged() -> Column:
    return F.coalesce(F.size("validate_draft_flags"), F.lit(0)) > 0


class Listing(NamedTuple):
    cond: Callable[[], Column]
    shown: tuple[str, ...]
    limit: int | None


LISTINGS = {
    "misclassified": Listing(is_misclassified, ("true_intent", "predicted_intent", "predicted_confidence"), 5),
    "missed_escalations": Listing(is_missed, ("true_escalation_decision", "escalation_decision", "escalation_reason"), None),
    "over_escalations": Listing(is_over_escalated, ("escalation_reason",), 2),
    "hard_case_failures": Listing(
        is_failed_hard_case,
        ("hard_case_category", "true_intent", "predicted_intent", "true_escalation_decision", "escalation_decision"), 5,
    ),
    "low_grounding": Listing(is_low_grounding, ("groundedness_score", "no_hallucinated_specifics_score"), 5),
    "flagged_drafts": Listing(is_flagged, ("flag_kinds",), 5),
}


def _detail(shown: Sequence[str]) -> Column:
    return F.concat_ws(" | ", *[
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in shown
    ])


def listing(
    df: DataFrame, name: str, cond: Column, shown: Sequence[str], limit: int | None = None, order: Sequence = ()
) -> DataFrame:
    """The first ``limit`` rows of a listing with its total; texts are cut as in the printed report."""
    rows = df.filter(cond)
    total = rows.agg(F.count("*").alias("n")).scalar()
    if limit is not None:
        rows = rows.orderBy(*order, ID).limit(limit)
    return rows.withColumn("total", total).select(
        F.lit(name).alias("listing"), "total", ID, F.substring("tweet_text", 1, 120).alias("tweet"),
        F.substring("drafted_reply", 1, 150).alias("reply"), _detail(shown).alias("detail"),
    )


def named_listing(df: DataFrame, name: str) -> DataFrame:
    """One of ``LISTINGS`` alone."""
    spec = LISTINGS[name]
    kinds = df.withColumn("flag_kinds", F.concat_ws(",", F.transform("validate_draft_flags", lambda f: f["kind"])))
    order = [F.col("predicted_confidence").desc_nulls_last()] if name == "misclassified" else []
    return listing(kinds, name, spec.cond(), spec.shown, spec.limit, order)


def failure_candidates(df: DataFrame) -> DataFrame:
    """All six listings in one frame, from one tagging pass instead of a pass per listing.

    Rows that are in a listing are written once, with texts cut, and totals, bounded and whole listings read them there.
    The bounded listings share one ranking whose constant bound is applied before the shuffle; the missed
    escalations are listed whole and are never ranked.
    """
    cut = df.select(
        ID, F.substring("tweet_text", 1, 120).alias("tweet"), F.substring("drafted_reply", 1, 150).alias("reply"),
        "hard_case_category", "true_intent", "predicted_intent", "predicted_confidence", "true_escalation_decision",
        "escalation_decision", "escalation_reason", "groundedness_score", "no_hallucinated_specifics_score",
        F.concat_ws(",", F.transform("validate_draft_flags", lambda f: f["kind"])).alias("flag_kinds"),
        F.array_compact(F.array(*[F.when(spec.cond(), F.lit(name)) for name, spec in LISTINGS.items()])).alias("names"),
    )
    tagged = staged(cut.withColumn("listing", F.explode("names")).drop("names"), "failures")
    totals = tagged.groupBy("listing").agg(F.count("*").alias("total"))  # one row per listing
    limits = {name: spec.limit for name, spec in LISTINGS.items() if spec.limit}
    first = F.when(F.col("listing") == "misclassified", F.col("predicted_confidence"))
    w = Window.partitionBy("listing").orderBy(first.desc_nulls_last(), ID)
    bounded = (
        tagged.filter(F.col("listing").isin(*limits)).withColumn("_n", F.row_number().over(w))
        .filter(F.col("_n") <= max(limits.values()))
        .filter(F.coalesce(*[F.when(F.col("listing") == n, F.col("_n") <= k) for n, k in limits.items()])).drop("_n")
    )
    whole = tagged.filter(~F.col("listing").isin(*limits))
    detail = F.coalesce(*[F.when(F.col("listing") == n, _detail(spec.shown)) for n, spec in LISTINGS.items()])
    return bounded.unionByName(whole).join(broadcast_up_to(totals, len(LISTINGS)), "listing").select(
        "listing", "total", ID, "tweet", "reply", detail.alias("detail")
    )


def cascade_failures(df: DataFrame) -> DataFrame:
    """Messages that were both misclassified and missed."""
    return df.filter(is_misclassified() & is_missed()).select(ID, "true_intent", "predicted_intent")
