"""What the library reads from the session, and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, whose executors are the driver, gets a folder of its own where it is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="triage-")
    spark.conf.set("spark.checkpoint.dir", folder)  # one folder for the session
    return folder


BROADCAST_ROWS = 10_000


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to hold at most ``rows`` short rows, marked for broadcast if those are very few; else left to
    the optimizer, which goes by bytes."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fits(df: DataFrame, column: str, most: int) -> bool:
    """Whether the rows of ``df``, each taken as the bytes of ``column`` and forty more, are at most ``most`` bytes."""
    size = df.agg(F.sum(F.octet_length(F.col(column).cast("string")) + 40).alias("x")).first()["x"]
    return (size or 0) <= most


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once and read back, for a result that several later steps scan."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
