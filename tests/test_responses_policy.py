import json

import pytest
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage import schemas
from spark_triage.functions import policy as po
from spark_triage.functions import prompts as pm
from spark_triage.functions import responses as rs
from spark_triage.operators import evaluate as ev
from spark_triage.operators import inference as inf

GOOD = '{"intent":"account_access","confidence":0.9}'
CASES = [
    (GOOD, "ok", 0.9), (f"x {GOOD} y", "ok", 0.9), (f"```json\n{GOOD}\n```", "ok", 0.9), (f"  {GOOD}\n", "ok", 0.9),
    ("{" + GOOD + "}", "retry", None), ('{"intent":"account_access","confidence":"0.8"}', "ok", 0.8),
    ('{"intent":"account_access","confidence":"high"}', "failed", None), (f"[{GOOD}]", "retry", None),
    ('{"intent":"zz","confidence":0.9}', "retry", None), ('{"intent":"account_access","confidence":null}', "retry", None),
    ('{"intent":"account_access"}', "retry", None), (GOOD + ' {"a":2}', "retry", None), (GOOD + "] junk}", "retry", None),
    (GOOD + "," + GOOD, "retry", None), ("nope", "retry", None), ("", "retry", None), (None, "retry", None),
    ("{'intent':'account_access','confidence':0.9}", "retry", None), ('"text"', "retry", None), ("{}", "retry", None),
    ('{"intent":{"a":1},"confidence":0.9}', "retry", None), ('{"intent":"account_access","confidence":1}', "ok", 1.0),
    (GOOD[:-1], "retry", None), ("see [1] " + GOOD, "ok", 0.9),
]


def test_parse_classification(apply):
    got = apply(rs.parse_classification, [c[0] for c in CASES])
    assert [(r["status"], r["confidence"]) for r in got] == [c[1:] for c in CASES]


def judge(**change):
    body = {d: {"score": 3, "rationale": "fine"} for d in fv.JUDGE_DIMENSIONS}
    for k, v in change.items():
        body[k] = v
    return json.dumps(body)


def test_parse_judge(apply):
    ok = [judge(), "Here you go: " + judge() + " done", judge(relevance={"score": 4.5, "rationale": "x"}),
          judge(relevance={"score": 5, "rationale": "x", "more": [1]})]
    bad = [judge(relevance={"score": 6, "rationale": "x"}), judge(relevance={"score": 0, "rationale": "x"}),
           judge(relevance={"score": "4", "rationale": "x"}), judge(relevance={"score": 4, "rationale": ""}),
           judge(relevance={"score": 4}), judge(relevance=4), judge(actionability=None), "[" + judge() + "]", "no", None]
    got = apply(rs.parse_judge, ok + bad)
    assert [r["valid"] for r in got] == [True] * len(ok) + [False] * len(bad)
    assert [r["relevance_score"] for r in got[:4]] == [3.0, 3.0, 4.5, 5.0]
    assert all(r["relevance_score"] is None and r["actionability_rationale"] is None for r in got[4:])


def test_rounds(spark):
    rows = [(1, 1, GOOD), (2, 1, "no"), (2, 2, GOOD), (3, 1, "no"), (3, 2, "no"), (4, 1, "no"),
            (5, 1, '{"intent":"account_access","confidence":"high"}'), (5, 2, GOOD)]
    df = spark.createDataFrame(rows, schemas.RESPONSES)
    rounds = inf.classification_round(df)
    got = {r.id: (r.intent, r.outcome, r.attempts) for r in rounds.collect()}
    assert got == {1: ("account_access", "ok", 1), 2: ("account_access", "ok", 2), 3: (None, "dead", 2),
                   4: (None, "retry", 1), 5: (None, "dead", 1)}
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(1, 6)], "id bigint, prompt string")
    assert [tuple(r) for r in inf.retry_prompts(prompts, rounds).collect()] == [(4, "p4" + fv.CLASSIFY_RETRY)]
    health = inf.response_health(df.withColumn("p", rs.parse_classification(F.col("raw"))), F.col("p.status"))
    assert {tuple(r) for r in health.collect()} == {(1, "ok", 1), (1, "retry", 3), (1, "failed", 1), (2, "ok", 2), (2, "retry", 1)}


def test_judge_round_takes_the_valid_attempt(spark):
    df = spark.createDataFrame([(1, 1, "no"), (1, 2, judge()), (2, 1, judge()), (3, 1, "no"), (3, 2, "no")], schemas.RESPONSES)
    got = {r.id: (r.attempt, r.valid, r.relevance_score) for r in inf.judge_round(df).collect()}
    assert got == {1: (2, True, 3.0), 2: (1, True, 3.0), 3: (1, False, None)}


def test_scorer_hand_off(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "bb")], "id bigint, prompt string")
    got = inf.score_prompts(prompts, lambda texts: [t.upper() for t in texts], attempt=2).collect()
    assert sorted(map(tuple, got)) == [(1, 2, "A"), (2, 2, "BB")]


def flags_of(spark, reply, top1=None):
    df = spark.createDataFrame([(reply, top1)], "r string, t string")
    row = df.select(po.validate_draft(F.col("r"), F.col("t")).alias("f")).select("f", po.flag_list_text(F.col("f")).alias("s")).first()
    return [(f.kind, f.detail) for f in row.f], row.s


def test_validate_draft(spark):
    assert flags_of(spark, "We are sorry to hear that.") == ([], "[]")
    got, text = flags_of(spark, "sorry, Bob! ^LR")
    assert got == [("signature", "^LR"), ("name", "Bob")]
    assert text == "[\"leftover agent signature '^LR'\", \"name used in draft: 'Bob' (names are banned by policy)\"]"
    got, text = flags_of(spark, "please check your order page now", "Please check your order page now! ^AB")
    assert got == [("near_verbatim", "100%")]
    assert text == "['near-verbatim: 100% token overlap with top-1 retrieved reply']"
    assert flags_of(spark, "please check", None)[0] == []
    twenty = [f"w{i}" for i in range(20)]
    assert flags_of(spark, " ".join(twenty), " ".join(twenty[:17] + ["x", "y", "z"]))[0] == [("near_verbatim", "85%")]
    assert flags_of(spark, " ".join(twenty), " ".join(twenty[:16] + ["v", "x", "y", "z"]))[0] == []


@pytest.mark.parametrize("args, want", [
    (("positive_feedback", 0.99, True, 0.9, []), ("escalate", "security/fraud keyword match")),
    (("account_access", 0.99, False, 0.9, ["x"]),
     ("escalate", "high-risk intent 'account_access': requires human for account/money/trust action, regardless of confidence")),
    (("positive_feedback", 0.99, False, 0.9, ["Bob"]),
     ("escalate", "generated reply failed automated safety validation: [\"name used in draft: 'Bob' (names are banned by policy)\"]")),
    (("positive_feedback", 0.5, False, 0.1, []), ("escalate", "confidence 0.50 < 0.9; retrieval_top1_similarity 0.10 < 0.74")),
    (("positive_feedback", 0.95, False, None, []), ("escalate", "retrieval_top1_similarity 0.00 < 0.74")),
    (("positive_feedback", None, None, 0.8, []), ("escalate", "confidence missing < 0.9")),
    (("positive_feedback", 0.90, False, 0.74, []), ("auto", "confidence 0.90 >= 0.9 and similarity 0.74 >= 0.74")),
])
def test_decide(spark, args, want):
    intent, conf, override, sim, names = args
    df = spark.createDataFrame([(intent, conf, override, sim, names)], "i string, c double, o boolean, s double, n array<string>")
    flags = F.transform("n", lambda n: F.struct(F.lit("name").alias("kind"), n.alias("detail"), F.lit(None).cast("double").alias("score")))
    row = df.select(po.decide(F.col("i"), F.col("c"), F.col("o"), F.col("s"), flags).alias("d")).first().d
    assert (row.decision, row.reason) == want


def test_reduced_policy_and_leaks(spark):
    df = spark.createDataFrame([("account_access", False, "auto"), ("positive_feedback", True, "auto"), ("positive_feedback", False, "auto")],
                               "predicted_intent string, fraud_override boolean, escalation_decision string")
    assert [r[0] for r in df.select(po.decide_by_intent(F.col("predicted_intent"))).collect()] == ["escalate", "auto", "auto"]
    assert tuple(ev.policy_leaks(df).first()) == (3, 2)


def test_routing(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "id int, fraud_override boolean")
    a, b = inf.draft_routing(df).orderBy("id").collect()
    assert (a.route, a.drafted_reply, a.retrieval_top1_similarity, a.validate_draft_flags) == ("holding", fv.HOLDING_MESSAGE, 0.0, [])
    assert (b.route, b.drafted_reply, b.validate_draft_flags) == ("draft", None, None)


def test_prompts(spark):
    df = spark.createDataFrame([("my text", [("c1", "r1 ^LR"), ("c2", "r2")])],
                               "t string, e array<struct<customer_tweet_clean:string,brand_reply_clean:string>>")
    row = df.select(
        pm.classify_prompt(F.col("t"), "Shop").alias("c"), pm.draft_prompt(F.col("t"), F.col("e"), "Shop", "Shop Inc").alias("d"),
        pm.judge_prompt(F.col("t"), F.lit("rep")).alias("j"), pm.query_text(F.col("t")).alias("q"),
    ).first()
    assert row.c.startswith("You are an intent classifier for Shop customer support tweets.") and '"my text"\n\nRespond with ONLY' in row.c
    assert all(f"- {i} (" in row.c for i in fv.INTENTS) and '    e.g. "will I be getting my postage refunded?"' in row.c
    assert '- Customer: "c1"\n  Shop: "r1"\n- Customer: "c2"\n  Shop: "r2"\n\nNow draft a reply to this customer tweet:\n"my text"\n\nRespond' in row.d
    assert 'CUSTOMER TWEET: "my text"\n\nAGENT REPLY: "rep"\n\nRespond' in row.j
    assert row.q == fv.QUERY_PREFIX + "my text"
