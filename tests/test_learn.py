"""From pseudo-labels to a model on disk and a corpus with intents, and the drafting trial."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.operators import models as md
from spark_triage.plans import learn, triage

INTENTS = ("refund", "delivery")
STOP = ("the",)


@pytest.fixture(scope="module")
def working(spark):
    rows = [(i, f"{'money back please' if i % 3 else 'where is parcel'} case{i % 5}") for i in range(60)]
    return spark.createDataFrame(rows, "customer_tweet_id bigint, customer_tweet_clean string")


@pytest.fixture(scope="module")
def responses(spark):
    raw = lambda i: "no json" if i % 10 == 9 else '{"intent":"%s","confidence":0.9}' % INTENTS[i % 3 == 0]
    return spark.createDataFrame([(i, 1, raw(i)) for i in range(60)], "id bigint, attempt int, raw string")


def test_train_save_load_report_and_backfill(spark, working, responses, tmp_path):
    corpus = working.select(F.col("customer_tweet_id").alias("brand_reply_id"), "customer_tweet_clean")
    out = learn.train_and_backfill(working, responses, corpus, str(tmp_path / "model"), n=40, intents=INTENTS, stop_words=STOP)
    labels = out["labels"].collect()
    assert 20 < len(labels) <= 40 and all(r.customer_tweet_id % 10 != 9 for r in labels)
    report = {r.label: r for r in out["report"].collect()}
    assert {x: report[x].support for x in INTENTS} == {x: sum(r.predicted_intent == x for r in labels) for x in INTENTS}
    assert all(report[x].precision == report[x].recall == 1 for x in INTENTS)
    got = {r.brand_reply_id: r.predicted_intent for r in out["corpus"].collect()}
    assert got == {i: INTENTS[i % 3 == 0] for i in range(60)}
    again = md.classify(corpus, learn.PipelineModel.load(str(tmp_path / "model")))
    assert {r.brand_reply_id: r.predicted_intent for r in again.collect()} == got


def test_gradient_vanishes_at_the_fit_and_nowhere_else(spark, working, responses):
    labels = triage.pseudo_labels(working, responses, INTENTS).select("customer_tweet_clean", "predicted_intent")
    for balanced in (False, True):
        model = md.train_classifier(labels, "customer_tweet_clean", "predicted_intent", balanced, stop_words=STOP)
        for r in md.gradients(labels, model, "customer_tweet_clean", "predicted_intent", balanced).collect():
            assert r.gradient < 1e-3 * r.gradient_at_zero
    early = md.train_classifier(labels, "customer_tweet_clean", "predicted_intent", stop_words=STOP, max_iter=1)
    assert all(r.gradient > 0.02 * r.gradient_at_zero for r in md.gradients(labels, early, "customer_tweet_clean", "predicted_intent").collect())
    assert {r.label: r.n for r in md.gradients(labels, early, "customer_tweet_clean", "predicted_intent").collect()} == {
        r.predicted_intent: r["count"] for r in labels.groupBy("predicted_intent").count().collect()}


def test_draft_trial(spark, working, responses):
    rng = np.random.default_rng(1)
    vectors = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(rng.normal(size=(60, 4)))]
    queries = spark.createDataFrame(vectors[:50], "customer_tweet_id bigint, embedding array<double>")  # some have none
    corpus = spark.createDataFrame(
        [(i, v, INTENTS[i % 2], f"text {i}", f"a reply of number {i} to you") for i, v in vectors],
        "rid bigint, embedding array<double>, predicted_intent string, customer_tweet_clean string, brand_reply_clean string")
    seen = []

    def draft(prompts):
        seen.extend(prompts.collect())
        return prompts.select("id", F.lit("hello, we look into it").alias("reply"))

    labels = triage.pseudo_labels(working, responses, INTENTS, patterns=["parcel case0"])
    forced = "where is parcel case0"
    out = learn.draft_trial(labels, queries, corpus, "rid", draft, forced=[forced], n=10)
    rows = out["rows"].collect()
    asked = {r.customer_tweet_id for r in labels.collect() if r.customer_tweet_clean == forced}
    assert asked and asked <= {r.customer_tweet_id for r in rows} and len(rows) == 10
    assert {r.customer_tweet_id for r in rows if r.forced} == asked
    held = {r.customer_tweet_id for r in rows if r.drafted_reply == fv.HOLDING_MESSAGE}
    assert held == asked and {r.id for r in seen} == {r.customer_tweet_id for r in rows} - held
    rate = out["rate"].first()
    assert rate.n_checked == len(rows) - len(held) and rate.n_flagged == 0
