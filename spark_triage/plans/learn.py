"""From pseudo-labels to a model on disk, its report, and a corpus with intents; and the drafting trial."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.operators import evaluate as ev
from spark_triage.operators import models as md
from spark_triage.operators import retrieval as rt
from spark_triage.operators import sampling as sm
from spark_triage.plans import triage as tr
from spark_triage.session import staged


def label_sample(
    working: DataFrame, responses: DataFrame, n: int = fv.PSEUDO_LABEL_ROWS, seed: int = fv.PSEUDO_LABEL_SEED,
    intents: Sequence[str] = fv.INTENTS, patterns: Sequence[str] = fv.FRAUD_PATTERNS,
) -> DataFrame:
    """Pseudo-labels of the seeded sample: rows whose answer is usable."""
    return tr.pseudo_labels(sm.seeded_sample(working, tr.ID, seed, n), responses, intents, patterns)


def pilot_run(
    working: DataFrame, responses: DataFrame, n: int = fv.PILOT_ROWS, seed: int = fv.PILOT_SEED,
    intents: Sequence[str] = fv.INTENTS, patterns: Sequence[str] = fv.FRAUD_PATTERNS,
) -> dict[str, DataFrame]:
    """A few messages before the whole run: ``rows`` with label, override and outcome (``missing`` without an answer), and
    ``counts`` of what became of them."""
    from spark_triage.functions import text as tx
    from spark_triage.operators import inference as inf

    drawn = staged(sm.seeded_sample(working, tr.ID, seed, n), "pilot")
    rounds = inf.classification_round(responses, intents).withColumnRenamed("id", tr.ID)
    rows = drawn.join(rounds, tr.ID, "left").select(
        tr.ID, tr.TEXT, F.col("intent").alias("predicted_intent"), "confidence", F.coalesce("outcome", F.lit("missing")).alias("outcome"),
        F.coalesce("attempts", F.lit(0)).alias("attempts"), tx.fraud_override(F.col(tr.TEXT), patterns).alias("fraud_override"))
    counts = rows.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("outcome") == "ok").alias("n_ok"),
        F.count_if((F.col("attempts") == 2) | (F.col("outcome") == "retry")).alias("n_retried"),
        F.count_if(F.col("outcome") == "dead").alias("n_failed"), F.count_if("fraud_override").alias("n_overridden"))
    return {"rows": rows, "counts": counts}


def compare_with_model(
    golden: DataFrame, pseudo: DataFrame, model: PipelineModel, text_col: str = "tweet_text",
    high_risk: Sequence[str] = fv.HIGH_RISK_INTENTS,
) -> dict[str, DataFrame]:
    """The comparison of methods with the fitted classifier as the simple one: it labels the golden texts, and the
    majority label comes from the pseudo-labels that it was fitted to."""
    from spark_triage.plans import assess

    told = golden.drop("simple_intent").withColumnRenamed("predicted_intent", "_system").withColumn(tr.TEXT, F.col(text_col))
    labelled = md.classify(told, model, "simple_intent").drop(tr.TEXT).withColumnRenamed("_system", "predicted_intent")
    return assess.baselines(labelled, pseudo, "simple_intent", high_risk)


def train_and_reload(
    labels: DataFrame, path: str, balanced: bool = False, stop_words: Sequence[str] | None = None
) -> PipelineModel:
    """The classifier fitted to the pseudo-labels, written to ``path`` and read back, as later runs will find it."""
    md.train_classifier(labels, tr.TEXT, "predicted_intent", balanced, stop_words=stop_words).write().save(path)
    return PipelineModel.load(path)


def train_and_backfill(
    working: DataFrame, responses: DataFrame, corpus: DataFrame, path: str, n: int = fv.PSEUDO_LABEL_ROWS,
    intents: Sequence[str] = fv.INTENTS, patterns: Sequence[str] = fv.FRAUD_PATTERNS, balanced: bool = True,
    stop_words: Sequence[str] | None = None,
) -> dict[str, DataFrame | PipelineModel]:
    """``labels``, the reloaded ``model``, its ``report`` on them, and ``corpus`` with an intent in every row.

    The report compares the model with the labels that it was fitted to, so it says how well the text explains them, not
    how well unseen messages are told apart.
    """
    labels = staged(label_sample(working, responses, n, intents=intents, patterns=patterns), "pseudo-labels")
    model = train_and_reload(labels, path, balanced, stop_words)
    told = labels.withColumnRenamed("predicted_intent", "true_intent")
    report = ev.classification_report(md.classify(told, model), "true_intent", "predicted_intent")
    return {"labels": labels, "model": model, "report": report, "corpus": md.classify(corpus, model)}


def build_retrieval(
    pairs: DataFrame, vectors: DataFrame, model: PipelineModel, id_col: str, min_length: int = fv.MIN_REPLY_LENGTH
) -> DataFrame:
    """The retrieval corpus: substantive pairs with their vectors and the intent of their message."""
    return md.classify(rt.build_corpus(pairs, vectors, id_col, min_length), model)


def draft_trial(
    labels: DataFrame, queries: DataFrame, corpus: DataFrame, corpus_id: str, draft: Callable[[DataFrame], DataFrame],
    forced: Sequence[str] = (), n: int = fv.DRAFT_TRIAL_ROWS, seed: int = fv.DRAFT_TRIAL_SEED,
    high_risk: Sequence[str] = fv.HIGH_RISK_INTENTS, allowlist: Sequence[str] = fv.NAME_ALLOWLIST,
    min_confidence: float = fv.CONFIDENCE_THRESHOLD, min_similarity: float = fv.SIMILARITY_THRESHOLD,
) -> dict[str, DataFrame]:
    """A small run of the drafting chain: all rows with a ``forced`` text and a sample by intent of the others, routed,
    matched with examples, drafted by ``draft`` ((id, prompt) to (id, reply)), checked and decided.

    ``rows`` are the decided ones, ``rate`` the share of near-verbatim replies among those that were drafted.
    """
    from spark_triage.operators import inference as inf

    drawn = staged(sm.forced_sample(labels, "predicted_intent", tr.ID, tr.TEXT, list(forced), n, seed), "trial")
    vectors = queries.select(tr.ID, "embedding")
    routed = staged(inf.draft_routing(drawn.drop("forced").join(vectors, tr.ID, "left")), "trial-routed")
    examples = staged(tr.examples_for(routed, corpus, corpus_id), "trial-examples")
    replies = draft(tr.draft_prompts(routed, examples, "brand", "company"))
    rows = tr.triage(routed, examples, replies, high_risk, allowlist, min_confidence, min_similarity)
    rows = rows.join(drawn.select(tr.ID, "forced"), tr.ID)
    was_drafted = F.col("drafted_reply") != fv.HOLDING_MESSAGE
    return {"rows": rows, "rate": ev.flag_rate(rows, "near_verbatim", was_drafted)}
