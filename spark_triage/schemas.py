"""Declared table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from spark_triage.fixed_values import JUDGE_DIMENSIONS

LONG, STRING, DOUBLE, BOOL, INT = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


FLAG = _table(kind=STRING, detail=STRING, score=DOUBLE)

MESSAGES = _table(
    tweet_id=LONG, author_id=STRING, inbound=BOOL, created_at=STRING, text=STRING, in_response_to_tweet_id=LONG
)
PAIRS = _table(
    customer_tweet_id=LONG, customer_tweet=STRING, customer_created_at=STRING, customer_in_response_to_tweet_id=LONG,
    brand_reply_id=LONG, brand_reply=STRING, brand_created_at=STRING,
)
CLEAN_PAIRS = T.StructType(
    PAIRS.fields + _table(has_link=BOOL, customer_tweet_clean=STRING, brand_reply_clean=STRING).fields
)
PSEUDO_LABELS = _table(
    customer_tweet_id=LONG, customer_tweet_clean=STRING, predicted_intent=STRING, confidence=DOUBLE, fraud_override=BOOL
)
RESPONSES = _table(id=LONG, attempt=INT, raw=STRING)
GOLDEN = _table(
    customer_tweet_id=LONG, hard_case_category=STRING, tweet_text=STRING, true_intent=STRING,
    true_escalation_decision=STRING, predicted_intent=STRING, predicted_confidence=DOUBLE, drafted_reply=STRING,
    escalation_decision=STRING, escalation_reason=STRING, validate_draft_flags=T.ArrayType(FLAG), notes=STRING,
)
JUDGE_SCORES = _table(
    customer_tweet_id=LONG,
    **{f"{d}_{part}": dtype for d in JUDGE_DIMENSIONS for part, dtype in (("score", DOUBLE), ("rationale", STRING))},
)
HUMAN_SCORES = _table(
    customer_tweet_id=LONG, hard_case_category=STRING, tweet_text=STRING, drafted_reply=STRING,
    **{f"{d}_score": DOUBLE for d in JUDGE_DIMENSIONS},
)
TAXONOMY = _table(intent=STRING, label=STRING, definition=STRING, examples=T.ArrayType(STRING))
