import numpy as np
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage import schemas
from spark_triage.operators import evaluate as ev
from spark_triage.operators import inference as inf
from spark_triage.operators import language as lg
from spark_triage.operators import profile as pf
from spark_triage.plans import assess, ingest, triage
from tests.test_language import TRAIN


def thread(spark):
    rows, n = [], 0
    for i in range(40):
        text = ["the dog is in the house", "die katze ist im haus", "where is the order that was sent"][i % 3]
        rows += [(n, f"c{i}", True, "t", f"@brand {text} {'' if i % 4 else chr(97 + i % 26) * 3}", None if i % 5 else 10_000),
                 (n + 1, "brand", False, "t", "we are on it" if i % 2 else f"the order {i} https://t.co/x", n)]
        n += 2
    return spark.createDataFrame(rows, schemas.MESSAGES)


def test_ingest_to_split(spark):
    m = thread(spark)
    got = ingest.ingest(m, "brand")
    assert got["pairs"].count() == 40 and got["deflection"].first().n_deflected == 20
    assert got["examples"].count() == 2 and got["reply_length"].first().n == 40
    profile = lg.language_profile(spark.createDataFrame(TRAIN, "id int, text string, lang string"), "text", "lang", ["de", "en"])
    cleaned = ingest.clean(got["pairs"], profile, ["de", "en"]).collect()
    texts = [r.customer_tweet_clean for r in cleaned]
    assert len(texts) == len(set(texts)) and all("katze" not in t and "@" not in t for t in texts)
    assert max(sum(r.brand_reply_clean == x.brand_reply_clean for x in cleaned) for r in cleaned) <= fv.REPLY_TEMPLATE_CAP
    steps = {r.step: (r.rows_in, r.rows_removed, r.rows_kept) for r in ingest.cleaning_funnel(got["pairs"], profile, ["de", "en"]).collect()}
    assert steps["pairs"] == (40, 0, 40) and steps["first_touch"] == (40, 8, 32)
    assert steps["template_cap"][2] == len(cleaned)
    assert steps["language"][0] == 32 and steps["dedupe"][0] == steps["language"][2]
    split = ingest.clean_and_split(got["pairs"], profile, ["de", "en"], working=3, heldout=2).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in split} == {"working": 3, "heldout": 2}


def vec(rng):
    v = rng.normal(size=6)
    return [float(x) for x in v / np.linalg.norm(v)]


def test_message_to_decision(spark):
    """Prompts go to a stand-in scorer, and its answers come back through parsing, retrieval, checks and policy."""
    rng = np.random.default_rng(4)
    texts = ["where is my parcel", "this is a scam", "love it", "refund me", "still nothing", "garbled"]
    rows = spark.createDataFrame([(i, t, "" if i else "pay", vec(rng)) for i, t in enumerate(texts)],
                                 "customer_tweet_id bigint, customer_tweet_clean string, hard_case_category string, embedding array<double>")
    corpus = spark.createDataFrame(
        [(i, f"old {i}", f"we are looking into order number {i} for you", fv.INTENTS[i % 8], vec(rng)) for i in range(40)],
        "pair_id bigint, customer_tweet_clean string, brand_reply_clean string, predicted_intent string, embedding array<double>")
    answers = {"where is my parcel": '{"intent":"delivery_shipping_issue","confidence":0.95}',
               "this is a scam": '{"intent":"general_complaint_other","confidence":0.9}',
               "love it": 'Sure: {"intent":"positive_feedback","confidence":0.97}',
               "refund me": '{"intent":"refund_return_dispute","confidence":0.99}', "still nothing": "no idea", "garbled": "no idea"}

    def classify(prompts, retry=False):
        out = []
        for p in prompts:
            text = p.split('Classify this customer tweet:\n"')[1].split('"\n')[0]
            out.append('{"intent":"delivery_shipping_issue","confidence":0.5}' if retry and text == "still nothing" else answers[text])
        return out

    prompts = triage.pseudo_label_prompts(rows, None, "Shop", n=6)
    assert prompts.count() == 6
    first = inf.score_prompts(prompts, classify)
    again = inf.retry_prompts(prompts, inf.classification_round(first))
    assert again.count() == 2
    responses = first.unionByName(inf.score_prompts(again, lambda p: classify(p, True), 2))
    labels = triage.pseudo_labels(rows, responses)
    assert {r.customer_tweet_id: r.fraud_override for r in labels.collect()} == {0: False, 1: True, 2: False, 3: False, 4: False}
    assert triage.pseudo_label_prompts(rows, labels, "Shop", n=6).count() == 1

    routed = triage.route(rows, labels)
    examples = triage.examples_for(routed, corpus, "pair_id")
    assert {r.query_id: r["count"] for r in examples.groupBy("query_id").count().collect()} == {i: 3 for i in (0, 2, 3, 4)}
    drafting = triage.draft_prompts(routed, examples, "Shop", "Shop Inc")
    assert drafting.count() == 4 and all(r.prompt.count("- Customer: ") == 3 for r in drafting.collect())

    replies = {0: "Please tell us more about it.", 2: "thanks so much, Bob!", 3: "We can help.", 4: " Please wait. "}
    drafts = spark.createDataFrame(list(replies.items()), "id bigint, reply string")
    out = triage.triage(routed, examples, drafts, min_similarity=-1.0)
    assert out.columns == schemas.GOLDEN.fieldNames()
    got = {r.customer_tweet_id: r for r in out.collect()}
    assert set(got) == {0, 1, 2, 3, 4}
    assert {i: r.escalation_decision for i, r in got.items()} == {0: "auto", 1: "escalate", 2: "escalate", 3: "escalate", 4: "escalate"}
    assert got[1].drafted_reply == fv.HOLDING_MESSAGE and got[1].validate_draft_flags == []
    assert got[2].validate_draft_flags[0].detail == "Bob" and got[3].escalation_reason.startswith("high-risk intent")
    assert got[4].drafted_reply == "Please wait." and got[4].escalation_reason.startswith("confidence 0.50 < 0.9")
    assert got[0].hard_case_category == "pay" and got[0].true_intent == ""
    leaks = out.withColumn("fraud_override", F.col("customer_tweet_id") == 1)
    assert ev.policy_leaks(leaks).first().n_leaked == 0


def test_assessment(spark):
    cats = ["", "a", "b"]
    golden = spark.createDataFrame(
        [(i, cats[i % 3], f"t{i}", "x", "auto", "x" if i % 2 else "y", 0.9, f"r{i}", "auto", "why", [], "") for i in range(60)], schemas.GOLDEN)
    template = assess.human_sample(golden, 10)
    assert template.schema.simpleString() == schemas.HUMAN_SCORES.simpleString() and template.count() == 10
    assert assess.judge_prompts(golden, golden.filter("customer_tweet_id < 50")).count() == 10
    raw = "{" + ",".join(f'"{d}":{{"score":3,"rationale":"ok"}}' for d in fv.JUDGE_DIMENSIONS) + "}"
    scores = assess.judge_scores(spark.createDataFrame([(1, 1, raw), (2, 1, "no")], schemas.RESPONSES))
    assert scores.count() == 1 and set(scores.columns) == set(schemas.JUDGE_SCORES.fieldNames())
    human = golden.select("customer_tweet_id", *[(1 + (F.col("customer_tweet_id") * (i + 1)) % 5).cast("double").alias(f"{d}_score")
                                                 for i, d in enumerate(fv.JUDGE_DIMENSIONS)])
    out = assess.calibration(human, human)
    lines = {r.dimension: r.line for r in out["lines"].collect()}
    assert lines["relevance"] == "| relevance | 1.000 | 0.000 | 100.0% |"
    assert assess.failures(golden, human).filter("listing = 'misclassified'").count() == 5
    base = assess.baselines(golden.withColumn("simple", F.lit("x")), golden, "simple")
    assert base["metrics"].count() == 3 and base["lines"].count() == 3


def test_threshold_study(spark):
    rng = np.random.default_rng(8)
    pseudo = spark.createDataFrame([(i, 0.7 + i % 30 / 100, vec(rng)) for i in range(100)], "customer_tweet_id bigint, confidence double, embedding array<double>")
    corpus = spark.createDataFrame([(i, vec(rng)) for i in range(50)], "pair_id bigint, embedding array<double>")
    study = assess.threshold_study(pseudo, corpus, "pair_id", n=20)
    got = {(r.score, r.point): r.value for r in study.collect()}
    assert len(got) == 10 and got["confidence", "min"] == 0.7 and got["max_similarity", "max"] <= 1.0
    assert pf.derive_thresholds(pseudo.withColumn("s", F.col("confidence")), "confidence", "s").count() == 2
