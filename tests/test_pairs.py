import pytest
from pyspark.sql import functions as F

from spark_triage import schemas
from spark_triage.operators import pairs as pr
from spark_triage.operators import profile as pf
from spark_triage.sources import standins


def messages(spark):
    rows = [
        (1, "c1", True, "t", "late &amp; lost", None), (2, "brand", False, "t", "see https://t.co/a", 1),
        (3, "brand", False, "t", "sorry", 1), (4, "c1", True, "t", "still", 2), (5, "brand", False, "t", "ok", 4),
        (6, "other", False, "t", "no", 1), (7, "brand", False, "t", "no parent", None), (8, "brand", False, "t", "to brand", 2),
        (9, "brand", False, "t", "lost parent", 999),
    ]
    return spark.createDataFrame(rows, schemas.MESSAGES)


def test_build_pairs(spark):
    pairs = pr.build_pairs(messages(spark), "brand")
    assert pairs.columns == schemas.PAIRS.fieldNames()
    assert sorted((r.customer_tweet_id, r.brand_reply_id) for r in pairs.collect()) == [(1, 2), (1, 3), (4, 5)]
    assert sorted(r.brand_reply_id for r in pr.first_touch(pairs).collect()) == [2, 3]
    cleaned = {r.brand_reply_id: r for r in pr.add_clean_columns(pairs).collect()}
    assert cleaned[2].has_link and cleaned[2].brand_reply_clean == "see <URL>" and not cleaned[3].has_link
    assert cleaned[2].customer_tweet_clean == "late & lost"


def test_hot_parent(spark):
    customers = spark.range(1000).select(
        F.col("id").alias("tweet_id"), F.lit("c").alias("author_id"), F.lit(True).alias("inbound"),
        F.lit("t").alias("created_at"), F.lit("x").alias("text"), F.lit(None).cast("bigint").alias("in_response_to_tweet_id"))
    replies = spark.range(1000, 7000).select(
        F.col("id").alias("tweet_id"), F.lit("brand").alias("author_id"), F.lit(False).alias("inbound"),
        F.lit("t").alias("created_at"), F.lit("y").alias("text"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).cast("bigint").alias("in_response_to_tweet_id"))
    assert pr.build_pairs(customers.unionByName(replies), "brand").count() == 6000


def test_dedupe_and_cap(spark):
    rows = [(i, "same" if i % 3 else f"t{i}", "tpl" if i % 2 else "r") for i in range(1, 40)]
    df = spark.createDataFrame(rows, "brand_reply_id bigint, customer_tweet_clean string, brand_reply_clean string")
    once = {r.brand_reply_id for r in pr.drop_duplicates(df).collect()}
    assert once == {1} | {i for i in range(1, 40) if i % 3 == 0}
    capped = sorted(r.brand_reply_id for r in pr.cap_templates(pr.drop_duplicates(df)).collect())
    odd, even = [i for i in sorted(once) if i % 2][:5], [i for i in sorted(once) if not i % 2][:5]
    assert capped == sorted(odd + even)
    counts = pf.dedupe_counts(df).first()
    assert (counts.n_deduped, counts.n_templates, counts.n_capped) == (len(once), 2, 10)
    plan = pr.cap_templates(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_substance_filter(spark):
    df = spark.createDataFrame([(1, False, "x" * 40), (2, False, "x" * 39), (3, True, "x" * 90), (4, False, None)],
                               "id int, has_link boolean, brand_reply_clean string")
    assert [r.id for r in pr.substance_filter(df).collect()] == [1]


def test_previous_in_group_is_independent_of_the_stretch(spark):
    rows = [(c, t, c * 1000 + t) for c in range(4) for t in range(0, 60, 1 + c) if (t * 7 + c) % 5]
    df = spark.createDataFrame(rows, "c bigint, t bigint, id bigint")
    want, last = {}, {}
    for c, t, i in sorted(rows):
        want[i] = last.get(c)
        last[c] = i
    for width in (1, 3, 10, 10_000):
        got = standins.previous_in_group(df, "c", "t", "id", "prev", width)
        assert {r.id: r.prev for r in got.collect()} == want


def test_length_profile_matches_pandas(spark):
    import pandas as pd

    texts = ["x" * n for n in (1, 5, 5, 9, 30, 31, 100, 7)]
    row = pf.length_profile(spark.createDataFrame([(t,) for t in texts], "t string"), "t").first()
    d = pd.Series([len(t) for t in texts]).describe().round(1)
    assert (row.n, row.mean, row.std, row.min, row.q1, row.median, row.q3, row.max) == (
        d["count"], d["mean"], d["std"], d["min"], d["25%"], d["50%"], d["75%"], d["max"])
    one = pf.length_profile(spark.createDataFrame([("abc",)], "t string"), "t").first()
    assert one.n == 1 and one.std is None


def test_rates_and_volume(spark):
    m = messages(spark)
    pairs = pr.build_pairs(m, "brand")
    r = pf.deflection_rate(pairs).first()
    assert (r.n, r.n_deflected) == (3, 1) and abs(r.rate - 1 / 3) < 1e-12
    assert [tuple(x) for x in pf.brand_volume(m, 5).collect()] == [("brand", 6), ("other", 1)]


def test_message_ids_of_long_conversations_do_not_collide(spark):
    rows = [(1, 999, "user"), (1, 1000, "assistant"), (2, 0, "user"), (2, 1, "assistant"), (1, 1001, "user"), (3, 10**9, "assistant")]
    turns = spark.createDataFrame([(c, t, r, "x") for c, t, r in rows], "conv_id bigint, turn bigint, role string, text string")
    messages = standins.messages_from_turns(turns, "b").collect()
    assert len({m.tweet_id for m in messages}) == 6
    parent = {m.tweet_id: m.in_response_to_tweet_id for m in messages}
    at = lambda c, t: (c << 32) + t
    assert parent == {at(1, 999): None, at(1, 1000): at(1, 999), at(1, 1001): at(1, 1000), at(2, 0): None, at(2, 1): at(2, 0), at(3, 10**9): None}


@pytest.mark.parametrize("conv, turn", [(1 << 31, 0), (1, 1 << 32), (-1, 0), (0, -1)])
def test_numbers_that_do_not_fit_a_message_id_are_refused(spark, conv, turn):
    turns = spark.createDataFrame([(conv, turn, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    with pytest.raises(Exception, match="does not fit"):
        standins.messages_from_turns(turns).collect()


def test_a_parent_with_a_third_of_the_replies_is_split(spark):
    """No task of the join gets more than twice the median, and the hot parent's replies all find it."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    n = 12_000
    replies = spark.range(n).select(
        (F.col("id") + 1_000_000).alias("tweet_id"), F.lit("acme").alias("author_id"), F.lit(False).alias("inbound"),
        F.lit("r").alias("text"), F.lit("t").alias("created_at"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 4000).alias("in_response_to_tweet_id"))
    parents = spark.range(4000).select(
        F.col("id").alias("tweet_id"), F.lit("c").alias("author_id"), F.lit(True).alias("inbound"), F.lit("q").alias("text"),
        F.lit("t").alias("created_at"), F.lit(None).cast("long").alias("in_response_to_tweet_id"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        pairs = pr.build_pairs(replies.union(parents), "acme")
        sizes = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == n and pairs.filter("customer_tweet_id = 5").count() > n // 3
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        assert pairs.select("brand_reply_id").distinct().count() == n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_keep_per_key_beyond_the_bound_before_the_shuffle(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"))
    for n in (900, 1500):
        got = {r.k: r for r in pr.keep_per_key(df, "k", ["id"], n).groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")).collect()}
        every = [i for i in range(9000) if i % 3 == 0]
        assert got["hot"].n == n and got["hot"].top == every[n - 1]
