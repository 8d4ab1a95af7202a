"""Message tables from conversation turns that carry no parent id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


TURN_BITS = 32


def previous_in_group(
    df: DataFrame, key: str, order: str, value: str, out: str, width: int = 10_000
) -> DataFrame:
    """``lag(value)`` within ``key`` by the integer column ``order``, with long groups split.

    A group is cut into stretches of ``width`` order values, so no task holds a whole group. The last
    value of each stretch is carried into the next one that has rows.
    """
    cut = df.withColumn("_stretch", F.floor(F.col(order) / width))
    tails = cut.groupBy(key, "_stretch").agg(F.max_by(value, order).alias(value))
    carried = (
        tails.withColumn("_stretch", F.lead("_stretch").over(Window.partitionBy(key).orderBy("_stretch")))
        .filter(F.col("_stretch").isNotNull())
        .select(key, "_stretch", value, F.lit(True).alias("_carried"))
    )
    both = cut.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy(key, "_stretch").orderBy(F.col("_carried").desc(), order)
    return (
        both.withColumn(out, F.lag(value).over(w)).filter(~F.col("_carried")).drop("_stretch", "_carried")
    )


def messages_from_turns(turns: DataFrame, brand: str = "brand") -> DataFrame:
    """(conv_id, turn, role, text) to the message schema; the parent is the previous spoken turn.

    A message id has the conversation above and the turn below its ``TURN_BITS`` low bits; numbers that do not fit
    are refused when the row is read.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    fits = conv.between(0, (1 << (63 - TURN_BITS)) - 1) & turn.between(0, (1 << TURN_BITS) - 1)
    message_id = F.when(fits, F.shiftleft(conv, TURN_BITS) + turn).when(
        conv.isNotNull() & turn.isNotNull(), F.raise_error(F.lit("conv_id or turn does not fit a message id")).cast("long"))
    spoken = turns.filter(F.col("role") != "system").withColumn("tweet_id", message_id)
    linked = previous_in_group(spoken, "conv_id", "turn", "tweet_id", "in_response_to_tweet_id")
    return linked.select(
        "tweet_id",
        F.when(F.col("role") == "assistant", F.lit(brand))
        .otherwise(F.concat(F.lit("cust"), F.col("conv_id").cast("string"))).alias("author_id"),
        (F.col("role") == "user").alias("inbound"),
        F.lit(None).cast("string").alias("created_at"),
        "text",
        "in_response_to_tweet_id",
    )
