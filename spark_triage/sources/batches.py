"""Appending batches exactly once.

A table is a folder: ``data/batch=<id>/attempt=<name>/`` holds rows, ``manifest/batch=<id>/`` one row that names the
attempt that counts, with its number of rows and a digest. Rows are written first and checked, then the manifest row is;
an attempt that no manifest names does not exist for readers. So a batch that is run again, or whose first run was lost
half-way, adds nothing twice.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "rows bigint, digest string, attempt string, batch string"


def digest(df: DataFrame) -> tuple[int, str]:
    """(rows, digest) of a table, whatever the order of its rows; repeated rows count."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    one = df.select(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))
    r = one.agg(
        F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("a"), F.sum(F.col("b").cast("decimal(38,0)")).alias("b")
    ).first()
    return r["n"], f"{r['a'] or 0}:{r['b'] or 0}"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(batch, attempt, rows, digest) of the batches that were committed."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType.fromDDL(MANIFEST))


def append_once(df: DataFrame, path: str, batch: str) -> bool:
    """Append ``df`` as ``batch``; True if it was added, False if the batch is there already.

    A batch of that name with other rows is refused. Two runs of one batch at a time: the second manifest is refused.
    """
    spark = df.sparkSession
    known = manifest(spark, path).filter(F.col("batch") == batch).first()
    if known is not None:
        if (known["rows"], known["digest"]) != digest(df):
            raise ValueError(f"batch {batch} was committed with other rows")
        return False
    attempt = uuid.uuid4().hex
    folder = f"{path}/data/batch={batch}/attempt={attempt}"
    df.write.parquet(folder)
    n, seen = digest(spark.read.schema(df.schema).parquet(folder))  # of what lies there, not of what was meant
    row = spark.createDataFrame([(n, seen, attempt)], "rows bigint, digest string, attempt string").coalesce(1)
    row.write.mode("error").parquet(f"{path}/manifest/batch={batch}")
    return True


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches, with ``batch``."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.StringType()), T.StructField("attempt", T.StringType())])
    try:
        rows = spark.read.schema(full).parquet(f"{path}/data")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], full)
    return rows.join(manifest(spark, path).select("batch", "attempt"), ["batch", "attempt"], "left_semi").drop("attempt")


def check_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(batch, rows, found): rows that the manifest names and rows that lie there."""
    found = read_batches(spark, path, schema).groupBy("batch").agg(F.count("*").alias("found"))
    return manifest(spark, path).join(found, "batch", "left").select("batch", "rows", F.coalesce("found", F.lit(0)).alias("found"))
