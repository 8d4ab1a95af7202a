"""Pairs of customer message and brand reply: building, cleaning, de-duplicating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import text as tx

GROUP_LIMIT = 1000  # Spark applies constant bounds up to this size before the shuffle


_HOT_KEYS = 2000  # that are split at most


def hot_parts(df: DataFrame, key: str, parts: int, keys: int = _HOT_KEYS) -> Column:
    """For joining ``df`` on ``key``: a scalar map from each key that holds more than one of ``parts`` equal parts of the
    rows, or one of ``keys`` if these are fewer, to the number of such parts that it fills.

    Tasks sketch the most frequent keys, and the sketches are merged; a key with that share cannot escape a sketch of
    ten times as many counters. What the sketch says decides only how rows are dealt, never which rows join.
    """
    sketch = F.expr(f"approx_top_k({key}, {keys}, {10 * keys})")
    total = df.filter(F.col(key).isNotNull()).agg(F.struct(sketch.alias("top"), F.count("*").alias("n")).alias("x")).select(
        F.map_from_entries(F.transform(
            F.filter("x.top", lambda t: t["count"] > F.col("x.n") / min(parts, keys)),
            lambda t: F.struct(t["item"], F.ceil(t["count"] * parts / F.col("x.n")).cast("int")))).alias("parts"))
    return total.scalar()


def build_pairs(messages: DataFrame, brand: str) -> DataFrame:
    """One row per brand reply whose parent is an inbound message.

    Both sides are filtered and pruned before the shuffle. A parent with very many replies is cut into parts, sixteen
    to a shuffle partition: its replies are dealt to them by id, and it alone is repeated, once for each part.
    """
    replies = messages.filter(
        (F.col("author_id") == brand) & F.col("in_response_to_tweet_id").isNotNull()
    ).select(
        F.col("in_response_to_tweet_id").alias("customer_tweet_id"),
        F.col("tweet_id").alias("brand_reply_id"),
        F.col("text").alias("brand_reply"),
        F.col("created_at").alias("brand_created_at"),
    )
    customers = messages.filter("inbound").select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("text").alias("customer_tweet"),
        F.col("created_at").alias("customer_created_at"),
        F.col("in_response_to_tweet_id").alias("customer_in_response_to_tweet_id"),
    )
    partitions = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_parts(replies.select("customer_tweet_id"), "customer_tweet_id", 16 * partitions)
    parts = F.coalesce(F.try_element_at("_hot", F.col("customer_tweet_id")), F.lit(1))
    dealt = replies.withColumn("_hot", hot).withColumn("_part", F.pmod(F.xxhash64("brand_reply_id"), parts).cast("int"))
    repeated = customers.withColumn("_hot", hot).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.drop("_hot").join(repeated.drop("_hot"), ["customer_tweet_id", "_part"]).select(
        "customer_tweet_id", "customer_tweet", "customer_created_at",
        "customer_in_response_to_tweet_id", "brand_reply_id", "brand_reply", "brand_created_at",
    )


def first_touch(pairs: DataFrame) -> DataFrame:
    """Pairs whose customer message opens the thread."""
    return pairs.filter(F.col("customer_in_response_to_tweet_id").isNull())


def add_clean_columns(pairs: DataFrame, link_pattern: str = fv.SHORT_LINK_PATTERN) -> DataFrame:
    return pairs.withColumns(
        {
            "has_link": tx.has_link(F.col("brand_reply"), link_pattern),
            "customer_tweet_clean": tx.clean_text(F.col("customer_tweet")),
            "brand_reply_clean": tx.clean_text(F.col("brand_reply")),
        }
    )


def keep_per_key(df: DataFrame, key: str, order: list[Column | str], n: int, salts: int = 256) -> DataFrame:
    """The first ``n`` rows of each key. The constant bound lets every map task keep only ``n`` per key
    before the shuffle, so a key that holds a third of the rows stays cheap; beyond the bound that Spark applies there,
    keys are first cut into salted parts, each of which keeps its first ``n``. The hash in front of the key
    lets the sorts compare eight bytes instead of long texts."""
    if n > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*[F.struct(*df.columns)]), F.lit(salts))
        part = Window.partitionBy(F.xxhash64(key), key, "_salt").orderBy(*order)
        df = df.withColumn("_salt", salt).withColumn("_n", F.row_number().over(part)).filter(F.col("_n") <= n).drop("_n", "_salt")
    w = Window.partitionBy(F.xxhash64(key), key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def drop_duplicates(pairs: DataFrame, text_col: str = "customer_tweet_clean", id_col: str = "brand_reply_id") -> DataFrame:
    """Exact duplicates of the cleaned message: the lowest reply id stays."""
    return keep_per_key(pairs, text_col, [id_col], 1)


def cap_templates(
    pairs: DataFrame, cap: int = fv.REPLY_TEMPLATE_CAP, text_col: str = "brand_reply_clean",
    id_col: str = "brand_reply_id",
) -> DataFrame:
    return keep_per_key(pairs, text_col, [id_col], cap)


def substance_filter(pairs: DataFrame, min_length: int = fv.MIN_REPLY_LENGTH) -> DataFrame:
    return pairs.filter(tx.is_substantive(F.col("has_link"), F.col("brand_reply_clean"), min_length))
