"""Reproducible samples: a row's place is the md5 of ``seed:id``, the same on every engine and layout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.operators.pairs import GROUP_LIMIT
from spark_triage.session import broadcast_up_to, staged

_BUCKETS = 60 * 1024 + 1
_PARTS = 64  # that the lowest rows of all tasks are dealt to


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _hash_bucket(key: Column) -> Column:
    """0..61440, never falling as the key grows, and finer the smaller the key is (1024 per doubling)."""
    head = F.conv(F.substring(key, 1, 15), 16, 10).cast("double") + 1
    return F.floor(F.log2(head) * 1024).cast("int")


def _low_rows(df: DataFrame, n: int) -> DataFrame:
    """Rows of each task that can be among its ``n`` with the least ``_head``: all that were when they came by. Only
    ``n`` numbers are held, never rows, and a task gives about n (1 + ln(rows / n)) of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, bar = np.zeros(0, np.uint64), np.uint64(2**64 - 1)
        for batch in batches:
            column = batch.column("_head")
            raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[8 * column.offset : 8 * (column.offset + len(column))]
            head = raw.view(">u8").astype(np.uint64)
            low = head <= bar
            least = np.concatenate([least, head[low]])
            if len(least) > n:
                least = np.partition(least, n - 1)[:n]
                bar = least.max()
                low &= head <= bar
            if low.any():
                yield batch.filter(pa.array(low))

    return df.mapInArrow(run, df.schema)


def bottom_rows(keyed: DataFrame, n: int) -> DataFrame:
    """At least the ``n`` rows with the least ``_key`` and few others, written, from one read of ``keyed``: each task
    keeps its lowest, these are dealt out by key and each part keeps its lowest again."""
    headed = keyed.withColumn("_head", F.unhex(F.substring("_key", 1, 16)))
    salt = F.pmod(F.xxhash64("_key"), F.lit(_PARTS))
    merged = _low_rows(_low_rows(headed, n).repartition(salt), n)
    return staged(merged.drop("_head"), "sample")


def ranked_sample(df: DataFrame, id_col: str, seed: int, n: int, rank_col: str = "sample_rank") -> DataFrame:
    """The first ``n`` rows in seeded order with their exact rank 1..n; ``id_col`` must be unique.

    ``df`` is read once; see ``bottom_rows``. On what is left, a histogram of at most 61,441 hash buckets tells where rank
    ``n`` falls, and rows are ranked bucket by bucket, not in one task.
    """
    keyed = df.withColumn("_key", hash_key(id_col, seed)).filter(F.col("_key").isNotNull())
    low = bottom_rows(keyed, n).withColumn("_bucket", _hash_bucket(F.col("_key")))
    before = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")
    buckets = (
        low.groupBy("_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_before", before).filter(F.col("_before") < n).select("_bucket", "_before")
    )
    inside = Window.partitionBy("_bucket").orderBy("_key", id_col)
    return (
        low.join(broadcast_up_to(buckets, _BUCKETS), "_bucket")
        .withColumn(rank_col, (F.col("_before") + F.row_number().over(inside)).cast("int"))
        .filter(F.col(rank_col) <= n)
        .drop("_key", "_bucket", "_before")
    )


def seeded_sample(df: DataFrame, id_col: str, seed: int, n: int) -> DataFrame:
    return ranked_sample(df, id_col, seed, n).drop("sample_rank")


def split_working_heldout(
    df: DataFrame, id_col: str, working: int = fv.WORKING_ROWS, heldout: int = fv.HELDOUT_ROWS,
    seed: int = fv.SPLIT_SEED,
) -> DataFrame:
    """Two disjoint samples, tagged ``split``: the first ``working`` rows, then the next ``heldout``."""
    return ranked_sample(df, id_col, seed, working + heldout).withColumn(
        "split", F.when(F.col("sample_rank") <= working, F.lit("working")).otherwise(F.lit("heldout"))
    ).drop("sample_rank")


def split_overlap(split: DataFrame, id_col: str) -> DataFrame:
    """Ids found in both halves (expected: none)."""
    both = split.filter("split = 'working'").select(id_col).intersect(
        split.filter("split = 'heldout'").select(id_col)
    )
    return both.agg(F.count("*").alias("n_overlap"))


def top_per_group(
    df: DataFrame, group: str, order: list[Column | str], n: int, id_col: str, rank_col: str = "_rank",
    salts: int = 256,
) -> DataFrame:
    """The first ``n`` rows of each group with their rank. Beyond the size that Spark prunes before the
    shuffle, groups are first cut into salted parts so that no task sorts a whole group."""
    if n > GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)))
        part = Window.partitionBy(group, "_salt").orderBy(*order)
        df = salted.withColumn("_part", F.row_number().over(part)).filter(F.col("_part") <= n).drop("_part", "_salt")
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def group_quotas(df: DataFrame, group: str, n_total: int, places: Column | None = None) -> DataFrame:
    """(group, quota): ``places`` (default ``n_total``) shared out evenly, the remainder going to the first
    groups in order.

    Only the first ``n_total`` groups can get a row, so the result never has more rows than that.
    """
    groups = staged(df.groupBy(group).agg(F.count("*").alias("_size")), "groups")
    n_groups = groups.agg(F.count("*").alias("n")).scalar()
    extra = (F.col("_i") < F.col("_places") % F.col("_groups")).cast("int")
    return (
        groups.orderBy(group).limit(n_total)
        .withColumn("_i", F.row_number().over(Window.orderBy(group)) - 1)
        .withColumn("_places", F.lit(n_total) if places is None else places)
        .withColumn("_groups", n_groups)
        .select(group, (F.floor(F.col("_places") / F.col("_groups")) + extra).cast("int").alias("quota"))
        .filter(F.col("quota") > 0)
    )


def stratified_sample(
    df: DataFrame, group: str, id_col: str, n_total: int, seed: int = 42, places: Column | None = None
) -> DataFrame:
    """Seeded sample with equal quotas per group. A group smaller than its quota gives all its rows; the
    shortfall is not handed to other groups."""
    wanted = df.join(broadcast_up_to(group_quotas(df, group, n_total, places), n_total), group)
    order = [hash_key(id_col, seed), F.col(id_col)]
    return (
        top_per_group(wanted, group, order, n_total, id_col)
        .filter(F.col("_rank") <= F.col("quota")).select(df.columns)
    )


def forced_sample(
    df: DataFrame, group: str, id_col: str, text_col: str, forced: list[str], n_total: int, seed: int
) -> DataFrame:
    """All rows with a listed text, then a stratified sample of the others for the places left."""
    listed = df.filter(F.col(text_col).isin(*forced))
    others = df.filter(~F.col(text_col).isin(*forced))
    places = F.greatest(F.lit(n_total) - listed.agg(F.count("*").alias("n")).scalar(), F.lit(0))
    picked = stratified_sample(others, group, id_col, n_total, seed, places)
    return listed.withColumn("forced", F.lit(True)).unionByName(picked.withColumn("forced", F.lit(False)))


def lowest(df: DataFrame, score: str, id_col: str, n: int) -> DataFrame:
    """The ``n`` rows with the lowest score, ties by id; rows without a score come last."""
    return df.orderBy(F.col(score).asc_nulls_last(), id_col).limit(n)
