"""Small helpers that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spark_triage.llm import wordhash as wh
from spark_triage.session import staged

__all__ = ["load", "lean_worker", "map_batches", "staged", "broadcast_checked", "bucket_ranks", "strip"]

_HIDDEN = "__llm_"
CACHES = ("encoder-", "counter-")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strip(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id (as ``doc_id``) and the text (as ``text``), whatever other columns there are."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def lean_worker(keeps: str = "") -> None:
    """Give back what a worker's last task left: unit caches but for those whose names begin with ``keeps``, functions
    that came by value, and free memory that the allocators hold."""
    for name in list(wh.worker_state()):
        if name.startswith(CACHES) and not (keeps and name.startswith(keeps)):
            del wh.worker_state()[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str | StructType,
                slice_bytes: int | None = None, keeps: str = "") -> DataFrame:
    """``fn`` applied to every Arrow batch of a task; it gives the columns of ``schema`` by name, or nothing.
    ``slice_bytes`` cuts a larger batch into slices of about that size first. Unit caches that a worker still has from
    other operators are dropped, but for those whose names begin with ``keeps``."""
    arrow = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker(keeps)
        for batch in batches:
            step = max(1, batch.num_rows * (slice_bytes or batch.nbytes) // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                out = fn(batch.slice(at, step))
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [x if isinstance(x, pa.Array) else pa.array(x, f.type) for f, x in
                         ((f, out[f.name]) for f in target)], schema=target)

    return df.mapInArrow(run, arrow)


def broadcast_checked(df: DataFrame, rows: int) -> DataFrame:
    """A written table of short rows, marked for broadcast if it holds at most ``rows``; beyond that it is joined by a
    shuffle like any other."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bucket_ranks(df: DataFrame, keys: list[str], order: list[Column], spread: Column, buckets: int, name: str,
                 staged_input: bool = True) -> DataFrame:
    """``df`` with ``name``: the gapless rank of each row within its keys, from 0.

    No key is ranked in one task: rows are ordered first by a bucket of ``spread``, then by ``order`` within it. The
    counts of the buckets give each bucket its first rank. ``df`` is read twice, so it should be a written table.
    """
    from pyspark.sql import Window

    bucket = _HIDDEN + "bucket"
    rows = df.withColumn(bucket, F.pmod(F.xxhash64(spread), F.lit(buckets)))
    counts = rows.groupBy(*keys, bucket).count()
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*keys, bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(_HIDDEN + "first"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    ranked = rows.withColumn(_HIDDEN + "in", F.row_number().over(inside) - 1)
    return (
        ranked.join(first, [*keys, bucket])
        .withColumn(name, (F.col(_HIDDEN + "first") + F.col(_HIDDEN + "in")).cast("long"))
        .drop(bucket, _HIDDEN + "first", _HIDDEN + "in")
    )
