"""Reading and writing tables: typed CSV scan, declared-schema re-reads, published outputs, resume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triage import schemas


def typed_messages(raw: DataFrame) -> DataFrame:
    """String columns to the message types; a parent id that is no number becomes NULL."""
    return raw.select(
        F.col("tweet_id").cast("bigint").alias("tweet_id"),
        "author_id",
        F.col("inbound").cast("boolean").alias("inbound"),
        "created_at",
        "text",
        F.col("in_response_to_tweet_id").try_cast("double").try_cast("bigint").alias("in_response_to_tweet_id"),
    )


def read_messages_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Six named columns of a message CSV, whatever other columns it has.

    Quoted line breaks need ``multi_line``, which reads each file in one task: keep the input in many
    files, or turn it off when texts hold no line breaks.
    """
    names = spark.read.option("header", True).csv(path).columns
    every = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return typed_messages(
        spark.read.schema(every).csv(path, header=True, multiLine=multi_line, escape='"')
        .select(schemas.MESSAGES.fieldNames())
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def publish(df: DataFrame, path: str, drop: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a stage output, leaving out columns that must not be published (raw text)."""
    df.drop(*drop).write.mode(mode).parquet(path)


def publishable(pairs: DataFrame) -> DataFrame:
    """Cleaned pairs without the raw text columns."""
    return pairs.drop("customer_tweet", "brand_reply")


def remaining(todo: DataFrame, done: DataFrame, id_col: str) -> DataFrame:
    """Rows not processed yet."""
    return todo.join(done.select(id_col), id_col, "left_anti")


def write_report(lines: DataFrame, path: str) -> None:
    """A report is a small frame of (line_no, line); written as one ordered text file."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
