"""From raw messages to cleaned, split pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import text as tx
from spark_triage.operators import language as lang
from spark_triage.operators import pairs as pr
from spark_triage.operators import profile as pf
from spark_triage.operators import sampling as sm

PAIR_ID = "brand_reply_id"


def ingest(messages: DataFrame, brand: str, patterns: Sequence[str] = fv.DEFLECTION_PATTERNS) -> dict[str, DataFrame]:
    """Pairs, their reply-length profile, deflection rate and one example per flag."""
    pairs = pr.build_pairs(messages, brand)
    flag = tx.deflection_flag(F.col("brand_reply"), patterns)
    return {
        "pairs": pairs,
        "reply_length": pf.length_profile(pairs, "brand_reply"),
        "deflection": pf.deflection_rate(pairs, patterns),
        "examples": pf.flag_examples(pairs, flag, "brand_reply", PAIR_ID),
    }


def _cleaned(
    pairs: DataFrame, profile: DataFrame, languages: Sequence[str], link_pattern: str
) -> DataFrame:
    """Cleaned pairs with the language of the customer's message (``detected``)."""
    return lang.detect_language(pr.add_clean_columns(pairs, link_pattern), "customer_tweet_clean", profile, languages)


def clean(
    pairs: DataFrame, profile: DataFrame, languages: Sequence[str], language: str = "en",
    link_pattern: str = fv.SHORT_LINK_PATTERN, cap: int = fv.REPLY_TEMPLATE_CAP,
) -> DataFrame:
    """Openers, clean, language, de-duplicate, cap: the order is part of the result."""
    spoken = lang.language_filter(_cleaned(pr.first_touch(pairs), profile, languages, link_pattern), language=language)
    return pr.cap_templates(pr.drop_duplicates(spoken.drop("detected")), cap)


def cleaning_funnel(
    pairs: DataFrame, profile: DataFrame, languages: Sequence[str], language: str = "en",
    link_pattern: str = fv.SHORT_LINK_PATTERN, cap: int = fv.REPLY_TEMPLATE_CAP,
) -> DataFrame:
    """Rows in, removed and kept at each step, from one pass over the pairs and their texts."""
    opener = F.col("customer_in_response_to_tweet_id").isNull()
    # the language of other rows is not asked for
    asked = pairs.withColumn("opener", opener).withColumn("customer_tweet", F.when(opener, F.col("customer_tweet")))
    tagged = _cleaned(asked, profile, languages, link_pattern).select(
        "opener", (F.col("opener") & F.col("detected").eqNullSafe(language)).alias("spoken"), "customer_tweet_clean",
        "brand_reply_clean", PAIR_ID)
    # one row for each distinct message, with the reply that stays and how many rows there were
    kept = F.when(F.col("spoken"), F.col("customer_tweet_clean"))
    unique = tagged.groupBy(F.col("spoken"), kept.alias("message")).agg(
        F.count("*").alias("pairs"), F.count_if("opener").alias("openers"),
        F.min_by("brand_reply_clean", F.when(F.col("spoken"), F.col(PAIR_ID))).alias("reply"))
    by_reply = unique.groupBy("spoken", "reply").agg(
        F.sum("pairs").alias("pairs"), F.sum("openers").alias("openers"), F.count("*").alias("messages"))
    spoken = lambda c: F.coalesce(F.sum(F.when(F.col("spoken"), c)), F.lit(0))
    totals = by_reply.agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("openers"), F.lit(0)).alias("first_touch"),
        spoken(F.col("pairs")).alias("language"), spoken(F.col("messages")).alias("dedupe"),
        spoken(F.least("messages", F.lit(cap))).alias("template_cap"))
    steps = ("pairs", "first_touch", "language", "dedupe", "template_cap")
    order = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col("step")).cast("int")
    return pf.funnel(totals.unpivot([], list(steps), "step", "rows_kept").withColumn("step_no", order))


def clean_and_split(
    pairs: DataFrame, profile: DataFrame, languages: Sequence[str], working: int = fv.WORKING_ROWS,
    heldout: int = fv.HELDOUT_ROWS, seed: int = fv.SPLIT_SEED, **kw,
) -> DataFrame:
    return sm.split_working_heldout(clean(pairs, profile, languages, **kw), PAIR_ID, working, heldout, seed)
