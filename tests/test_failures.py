from pyspark.sql import functions as F

from spark_triage import schemas
from spark_triage.operators import failures as fl

FLAG = [("name", "Bob", None)]


def golden(spark):
    def row(i, cat, ti, te, pi, conf, dec, flags=()):
        return (i, cat, f"tweet {i} " + "x" * 200, ti, te, pi, conf, f"reply {i} " + "y" * 200, dec, "why", list(flags), "")

    rows = [
        row(1, "", "a", "auto", "b", 0.7, "auto"), row(2, "fraud_keyword", "a", "escalate", "b", 0.9, "auto"),
        row(3, None, "a", "auto", "a", 0.9, "escalate", FLAG), row(4, "", None, "auto", None, 0.8, "escalate"),
        row(5, "pay", "a", "auto", "a", 0.9, "auto"), row(6, "", "a", "escalate", "a", 0.9, "auto"),
        row(7, "", "a", "auto", "a", 0.9, "escalate"), row(8, "x", "a", None, "a", 0.9, "auto"),
    ] + [row(i, "", "a", "auto", "b", 0.5, "auto") for i in range(20, 26)]
    return spark.createDataFrame(rows, schemas.GOLDEN)


def judge(spark):
    return spark.createDataFrame([(1, 2.0, 5.0), (2, 3.0, 1.0), (3, 3.0, 3.0)],
                                 "customer_tweet_id bigint, groundedness_score double, no_hallucinated_specifics_score double")


def ids(df):
    return [r.customer_tweet_id for r in df.collect()]


def test_listings(spark):
    df = fl.golden_with_scores(golden(spark), judge(spark)).cache()
    assert df.count() == 14
    mis = fl.named_listing(df, "misclassified")
    assert ids(mis) == [2, 4, 1, 20, 21] and mis.first().total == 9
    assert sorted(ids(fl.named_listing(df, "missed_escalations"))) == [2, 6]
    over = fl.named_listing(df, "over_escalations")
    assert ids(over) == [3, 4] and over.first().total == 3
    assert ids(fl.named_listing(df, "hard_case_failures")) == [2, 8]
    assert ids(fl.named_listing(df, "low_grounding")) == [1, 2]
    assert ids(fl.named_listing(df, "flagged_drafts")) == [3]
    row = over.first()
    assert len(row.tweet) == 120 and len(row.reply) == 150 and row.detail == "escalation_reason=why"
    assert fl.cascade_failures(df).first().customer_tweet_id == 2
    one_by_one = {(r.listing, r.total, r.customer_tweet_id, r.detail) for n in fl.LISTINGS for r in fl.named_listing(df, n).collect()}
    assert {(r.listing, r.total, r.customer_tweet_id, r.detail) for r in fl.failure_candidates(df).collect()} == one_by_one


def test_missing_values_differ(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(fl.differs("x", "y")).collect()] == [False, True, True, True]


def test_listing_of_nothing(spark):
    df = fl.golden_with_scores(golden(spark), judge(spark)).filter(F.lit(False))
    assert fl.failure_candidates(df).count() == 0 and fl.named_listing(df, "misclassified").count() == 0
