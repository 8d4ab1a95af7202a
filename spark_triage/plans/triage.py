"""From messages to decisions, with the model calls done outside: prompts go out, responses come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import policy as po
from spark_triage.functions import prompts as pm
from spark_triage.functions import text as tx
from spark_triage.operators import inference as inf
from spark_triage.operators import retrieval as rt
from spark_triage.operators import sampling as sm
from spark_triage.sources.tables import remaining

ID = "customer_tweet_id"
TEXT = "customer_tweet_clean"


def pseudo_label_prompts(
    working: DataFrame, done: DataFrame | None, brand: str, n: int = fv.PSEUDO_LABEL_ROWS, seed: int = fv.PSEUDO_LABEL_SEED
) -> DataFrame:
    """(id, prompt) of the seeded sample, without rows that already have an answer."""
    sample = sm.seeded_sample(working, ID, seed, n)
    todo = sample if done is None else remaining(sample, done, ID)
    return todo.select(F.col(ID).alias("id"), pm.classify_prompt(F.col(TEXT), brand).alias("prompt"))


def pseudo_labels(rows: DataFrame, responses: DataFrame, intents=fv.INTENTS, patterns=fv.FRAUD_PATTERNS) -> DataFrame:
    """(id, text, intent, confidence, fraud_override) of usable answers."""
    ok = inf.classification_round(responses, intents).filter("outcome = 'ok'")
    return rows.join(ok, rows[ID] == ok["id"]).select(
        ID, TEXT, F.col("intent").alias("predicted_intent"), "confidence",
        tx.fraud_override(F.col(TEXT), patterns).alias("fraud_override"),
    )


def route(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows with their route; ``rows`` may carry vectors and a hard-case category."""
    extra = labels.select(ID, "predicted_intent", "confidence", "fraud_override")
    return inf.draft_routing(rows.join(extra, ID))


def examples_for(routed: DataFrame, corpus: DataFrame, corpus_id: str, vector: str = "embedding") -> DataFrame:
    """Ranked few-shot examples with their texts, only for rows that go to drafting."""
    queries = routed.filter("route = 'draft'").select(ID, "predicted_intent", vector)
    found = rt.retrieve_examples(queries, corpus, ID, corpus_id, "predicted_intent", "predicted_intent", vector=vector)
    texts = corpus.select(F.col(corpus_id).alias("corpus_id"), TEXT, "brand_reply_clean")
    return found.select("query_id", "corpus_id", "similarity", "example_no").join(texts, "corpus_id")


def draft_prompts(routed: DataFrame, examples: DataFrame, brand: str, company: str) -> DataFrame:
    """(id, prompt) for every row that goes to drafting; at most three examples each, none where nothing was found."""
    shown = examples.groupBy(F.col("query_id").alias(ID)).agg(
        F.array_sort(F.collect_list(F.struct("example_no", TEXT, "brand_reply_clean"))).alias("examples")
    )
    return routed.filter("route = 'draft'").join(shown, ID, "left").select(
        F.col(ID).alias("id"), pm.draft_prompt(F.col(TEXT), F.col("examples"), brand, company).alias("prompt")
    )


def _answered(reply: Column) -> Column:
    """Whether a routed row can be decided: it is overridden or has a reply."""
    return F.coalesce(F.col("fraud_override"), F.lit(False)) | reply.isNotNull()


def triage_dead_letters(rows: DataFrame, labels: DataFrame, responses: DataFrame, drafts: DataFrame) -> DataFrame:
    """(id, stage, reason) of every row that ``pseudo_labels`` or ``triage`` leaves out, each once.

    stage ``classify``: the answer was unusable (``dead``), waits for its second attempt (``retry``) or never came
    (``missing``); stage ``draft``: the label is there, but no reply (``missing``).
    """
    outcomes = inf.classification_round(responses).select(F.col("id").alias(ID), "outcome")
    seen = rows.select(ID).join(labels.select(ID, "fraud_override"), ID, "left").join(outcomes, ID, "left").join(
        drafts.select(F.col("id").alias(ID), F.col("reply").alias("_reply")), ID, "left")
    labelled = F.col("fraud_override").isNotNull()
    return seen.filter(~labelled | ~_answered(F.col("_reply"))).select(
        ID, F.when(labelled, F.lit("draft")).otherwise(F.lit("classify")).alias("stage"),
        F.when(labelled | F.col("outcome").isNull(), F.lit("missing")).otherwise(F.col("outcome")).alias("reason"))


def triage(
    routed: DataFrame, examples: DataFrame, drafts: DataFrame, high_risk=fv.HIGH_RISK_INTENTS,
    allowlist=fv.NAME_ALLOWLIST, min_confidence: float = fv.CONFIDENCE_THRESHOLD,
    min_similarity: float = fv.SIMILARITY_THRESHOLD, brand: str | None = None,
) -> DataFrame:
    """Evaluation rows: reply, flags and decision. ``drafts`` is (id, reply) from the caller's model. Rows without a
    reply are in ``triage_dead_letters``."""
    top1 = examples.filter("example_no = 1").select(
        F.col("query_id").alias(ID), F.col("similarity").alias("_sim"), F.col("brand_reply_clean").alias("_top1")
    )
    replies = drafts.select(F.col("id").alias(ID), F.trim("reply").alias("_reply"))
    joined = routed.join(top1, ID, "left").join(replies, ID, "left").filter(_answered(F.col("_reply")))
    filled = joined.withColumns(
        {
            "drafted_reply": F.coalesce("drafted_reply", "_reply"),
            "retrieval_top1_similarity": F.coalesce("retrieval_top1_similarity", "_sim", F.lit(0.0)),
            "validate_draft_flags": F.coalesce(
                "validate_draft_flags", po.validate_draft(F.col("_reply"), F.col("_top1"), allowlist, brand=brand)
            ),
        }
    )
    decided = po.decide(
        F.col("predicted_intent"), F.col("confidence"), F.col("fraud_override"), F.col("retrieval_top1_similarity"),
        F.col("validate_draft_flags"), high_risk, min_confidence, min_similarity,
    )
    category = F.col("hard_case_category") if "hard_case_category" in routed.columns else F.lit("")
    return filled.withColumn("_d", decided).select(
        ID, category.alias("hard_case_category"), F.col(TEXT).alias("tweet_text"),
        F.lit("").alias("true_intent"), F.lit("").alias("true_escalation_decision"), "predicted_intent",
        F.col("confidence").alias("predicted_confidence"), "drafted_reply",
        F.col("_d.decision").alias("escalation_decision"), F.col("_d.reason").alias("escalation_reason"),
        "validate_draft_flags", F.lit("").alias("notes"),
    )
