"""Exact inner-product top-k by block-at-a-time pruning.

Vectors become integers, and rows are dealt by a hash into *ranges* of bounded size. A range orders its rows so that
like vectors are neighbours and cuts them into blocks with a forward index (the vectors) and, per term (component),
the highest and lowest value. For a query the bound of a block is the sum of its largest possible term products. Blocks
are taken by falling bound, some at a time, until the next bound is below the k-th best score so far, so what is left
out cannot enter the answer; equal bounds are still scored, for ties.

A query meets the ranges in rounds, one first, then in each round sixteen times as many as before. The k-th best score of
a round is the floor of the next, and only scores that reach it leave a task, so about 16 k rows of a query come together
in a round, however many ranges there are. Ranges and groups of queries are bounded in rows, so a task holds one of each
whatever the tables' sizes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage.llm.common import staged

RANGE_ROWS = 8192
QUERY_ROWS = 4096
BLOCK = 64
GROWTH = 16  # of the ranges that a query has met, from round to round
SCALE = 256
NOTHING = -(1 << 63)


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v: array of long): floor(scale * x); vectors that are null or hold null or non-finite values are left
    out, as are rows without an id."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _neighbours(x: np.ndarray) -> np.ndarray:
    """An order in which like vectors stand together: by the closest of some evenly chosen rows."""
    pivots = x[:: max(1, len(x) // 64)][:64].astype(np.float64)
    norm = np.sqrt((pivots**2).sum(1)) + 1e-9
    near = x.astype(np.float64) @ (pivots / norm[:, None]).T
    return np.lexsort((-near.max(1), near.argmax(1)))


def search_range(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int,
                 block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, vec_id, score, blocks scored) of the best ``k`` of this range for every query that reach its floor."""
    order = _neighbours(x)
    ids, x = ids[order], x[order]
    first = np.arange(0, len(x), block)
    high, low = np.maximum.reduceat(x, first, axis=0), np.minimum.reduceat(x, first, axis=0)
    exact = np.float64 if int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, x.shape[1]) < 1 << 53 else np.int64
    x, high, low, q = x.astype(exact), high.astype(exact), low.astype(exact), q.astype(exact)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    rows, found, scores, scored = [], [], [], 0
    for i in range(len(q)):
        turn = np.argsort(-bounds[i], kind="stable")
        best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        floor, at, step = int(floors[i]), 0, 2
        while at < len(turn) and bounds[i, turn[at]] >= floor:
            some = turn[at : at + step]
            some = some[bounds[i, some] >= floor]
            at, step = at + step, min(2 * step, 32)
            scored += len(some)
            places = (first[some][:, None] + np.arange(block)).reshape(-1)
            places = places[places < len(x)]
            got = (x[places] @ q[i]).astype(np.int64)
            keep = (got >= floor) & (ids[places] != query_ids[i])
            best_id, best = np.append(best_id, ids[places[keep]]), np.append(best, got[keep])
            if len(best) > k:
                top = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[top], best[top]
            if len(best) == k:
                floor = max(floor, int(best.min()))
        rows.append(np.full(len(best), i))
        found.append(best_id)
        scores.append(best)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores), scored


def _met(queries: DataFrame, rows: DataFrame, k: int, block: int) -> DataFrame:
    """(query_id, vec_id, score) of queries (query_id, v, floor) and rows with the same (dim, rng, grp)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
        if left.num_rows and right.num_rows:
            width = left.column("dim")[0].as_py()
            query_ids = left.column("query_id").to_numpy()
            row, vec, score, _ = search_range(
                right.column("vec_id").to_numpy(), _matrix(right.column("v"), width), query_ids,
                _matrix(left.column("v"), width), left.column("floor").to_numpy(), k, block)
            out = {"query_id": pa.array(query_ids[row.astype(np.int64)]), "vec_id": pa.array(vec), "score": pa.array(score)}
        return pa.table(out)

    key = ["dim", "rng", "grp"]
    return queries.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(
        run, "query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          range_rows: int = RANGE_ROWS, query_rows: int = QUERY_ROWS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest scores, all if fewer; ties go to the smaller id.

    Queries are the rows where ``is_query``; every row but those with the query's own id is a candidate. Vectors that
    are null or hold null or non-finite values take no part, and vectors of different lengths do not meet. A row that
    is repeated is a candidate each time; a query that is repeated is asked once, by the smallest vector. Empty vectors
    score 0 with each other. Sums of products must fit 64 bits. Further columns are left out.
    """
    rows = staged(integer_vectors(vectors, id_col, vec_col).withColumn("dim", F.size("v")), "topk-vectors")
    asked = staged(rows.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
                   .withColumn("dim", F.size("v")), "topk-queries")
    ranges = max(1, -(-rows.count() // range_rows))
    groups = max(1, -(-asked.count() // query_rows))
    spread = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    # a repeated id stands on several rows, so the place depends on a row number as well
    homed = rows.withColumn("rng", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(ranges)).cast("int"))
    homed = staged(homed, "topk-homed")
    grouped = staged(asked.withColumn("grp", spread("query_id", groups)), "topk-asked")
    wide = homed.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    home = F.pmod(F.col("grp"), F.lit(ranges))  # where a group of queries begins
    best_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    met, upto, best = 0, 1, None
    while True:
        step = F.explode(F.sequence(F.lit(met), F.lit(min(upto, ranges) - 1)))
        ask = grouped.withColumn("floor", F.lit(NOTHING))
        if best is not None:
            floors = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("reached")).filter(F.col("n") >= k)
            ask = grouped.join(floors.drop("n"), "query_id", "left").withColumn("floor", F.coalesce("reached", F.lit(NOTHING))).drop("reached")
        ask = ask.withColumn("step", step).withColumn("rng", F.pmod(home + F.col("step"), F.lit(ranges)).cast("int")).drop("step")
        here = F.pmod(F.col("rng") - home, F.lit(ranges)).between(met, upto - 1)
        hits = _met(ask, wide.filter(here), k, block)
        hits = hits if best is None else hits.unionByName(best)
        ranked = hits.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
        if upto >= ranges:
            return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        best = staged(ranked.drop("rank"), "topk-best")
        met, upto = upto, GROWTH * upto
