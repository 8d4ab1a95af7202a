"""Exact similarity search over unit vectors, and what is built on it.

Three layouts give the same rows. When one side is small (its bytes are checked), it is sent to the
tasks that read the other side. When neither is, both sides are cut into blocks and every pair of
blocks meets in one task. No layout makes pairs as rows: a task gives at most k per query. When many tasks hold parts
of the corpus, a query's k-th best similarity on a sixteenth of it is found first, by the same means, and only rows
that reach this floor leave the tasks: about sixteen times k for a query, however many tasks there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.session import staged

BROADCAST_BYTES = 16 * 1024 * 1024
BLOCK_BYTES = 16 * 1024 * 1024  # four tasks of an executor hold two blocks each, and their slices
BLOCK_ROWS = 4096
FIRST_ROWS = 65_536  # about as many corpus rows give the first floors
GROWTH = 16  # each round sees so many times the rows of the last
DECIMALS = 9  # similarities are ranked at this precision, so block shapes cannot change an order


def _block_top_k(q_ids, q, c_ids, c, k: int, floors=None) -> pd.DataFrame:
    """The k best corpus rows of each query in one pair of blocks, ties by corpus id, without rows below the query's
    floor. Both sides are taken in slices, so the similarity matrix stays at a few megabytes whatever the block sizes
    are, and a query's k-th best so far is the floor of its next slices."""
    order = np.argsort(c_ids, kind="stable")  # of equals, an earlier slice has the lower ids
    done = []
    for rows in _slices(len(q_ids), max(1, BLOCK_ROWS // 16)):
        found = None
        floor = np.full(rows.stop - rows.start, -np.inf) if floors is None else floors[rows]
        for cols in _slices(len(c_ids)):
            sims = q[rows] @ c[order[cols]].T
            if found is None and sims.shape[1] > k:
                floor = np.maximum(floor, np.round(np.partition(sims, sims.shape[1] - k, axis=1)[:, -k], DECIMALS))
            row, col = np.nonzero(sims >= floor[:, None] - 10.0**-DECIMALS)
            sim = np.round(sims[row, col], DECIMALS) + 0.0
            keep = sim >= floor[row]
            new = row[keep], order[cols][col[keep]], sim[keep]
            if found is None or len(new[0]):
                found = _best(*(new if found is None else map(np.concatenate, zip(found, new))), c_ids, k)
                floor = np.maximum(floor, _kth(found[0], found[2], len(floor), k))
        if found is not None:
            done.append((found[0] + rows.start, *found[1:]))
    row, col, sim = map(np.concatenate, zip(*done)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pd.DataFrame({"query_id": q_ids[row], "corpus_id": c_ids[col], "similarity": sim, "row": row})


def _best(row, col, sim, ids, k: int):
    """Of rows (row, col, similarity) the k best of each query row, ties by corpus id, by query row."""
    at = np.lexsort((ids[col], -sim, row))
    row = row[at]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[at][place < k], sim[at][place < k]


def _kth(row, sim, n: int, k: int) -> np.ndarray:
    """The k-th similarity of each of ``n`` query rows in what ``_best`` gives; of one with fewer, minus infinity."""
    out = np.full(n, -np.inf)
    last = np.arange(len(row)) - np.searchsorted(row, row) == k - 1
    out[row[last]] = sim[last]
    return out


def _slices(n: int, step: int | None = None) -> Iterator[slice]:
    step = step or BLOCK_ROWS
    return (slice(at, min(n, at + step)) for at in range(0, n, step))


def _side(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) of a block."""
    flat = table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return table["id"].to_numpy(), flat.reshape(table.num_rows, -1)


def _collect_checked(df: DataFrame, *more: str):
    """(ids, matrix, further columns..) of a side whose bytes have been checked."""
    rows = df.select("id", F.col("vec").cast("array<double>").alias("vec"), *more).toArrow()
    flat = rows["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, 0))
    return rows["id"].to_numpy(), matrix, *[rows[m].to_numpy() for m in more]


_SCHEMA = "query_id bigint, corpus_id bigint, similarity double"
_ARROW = pa.schema([("query_id", pa.int64()), ("corpus_id", pa.int64()), ("similarity", pa.float64())])


def _given(found: pd.DataFrame) -> pa.Table:
    return pa.Table.from_pandas(found[_ARROW.names], schema=_ARROW, preserve_index=False)


def _corpus_sent(q: DataFrame, c: DataFrame, k: int) -> DataFrame:
    small = q.sparkSession.sparkContext.broadcast(_collect_checked(c))

    def per_query(batches):
        ids, mat = small.value
        for batch in batches:
            if batch.num_rows and len(ids):
                yield from _given(_block_top_k(*_side(pa.Table.from_batches([batch])), ids, mat, k)).to_batches()

    return q.select("id", "vec").mapInArrow(per_query, _SCHEMA)


def _queries_sent(q: DataFrame, c: DataFrame, k: int) -> DataFrame:
    small = q.sparkSession.sparkContext.broadcast(_collect_checked(q, "floor"))

    def per_corpus(batches):
        ids, mat, floors = small.value
        best, reached = None, floors
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            c_ids, c = _side(pa.Table.from_batches([batch]))
            new = _block_top_k(ids, mat, c_ids, c, k, reached)
            new = new["row"].to_numpy(), new["corpus_id"].to_numpy(), new["similarity"].to_numpy()
            row, corpus_id, sim = new if best is None else map(np.concatenate, zip(best, new))
            row, at, sim = _best(row, np.arange(len(row)), sim, corpus_id, k)
            best = row, corpus_id[at], sim
            reached = np.maximum(floors, _kth(row, sim, len(ids), k))  # of equals, the lower id may come later
        if best is not None:
            row, corpus_id, sim = best
            yield from _given(pd.DataFrame({"query_id": ids[row], "corpus_id": corpus_id, "similarity": sim})).to_batches()

    return c.select("id", "vec").mapInArrow(per_corpus, _SCHEMA)


def _blocks(q: DataFrame, c: DataFrame, k: int, n_qb: int, n_cb: int) -> DataFrame:
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n: F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n)).cast("int")
    qb = q.select("id", "vec", "floor").withColumn("qb", place(n_qb)).withColumn("cb", spread(n_cb))
    cb = c.select("id", "vec").withColumn("cb", place(n_cb)).withColumn("qb", spread(n_qb))

    def per_cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _ARROW.empty_table()
        return _given(_block_top_k(*_side(left), *_side(right), k, left["floor"].to_numpy()))

    return qb.groupBy("qb", "cb").cogroup(cb.groupBy("qb", "cb")).applyInArrow(per_cell, _SCHEMA)


def candidates(
    queries: DataFrame, corpus: DataFrame, k: int, query_id: str, corpus_id: str, vector: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES, block_rows: int | None = None, first_rows: int = FIRST_ROWS,
) -> DataFrame:
    """(query_id, corpus_id, similarity): what the tasks give, among it the k best of every query."""
    q = queries.filter(F.col(vector).isNotNull()).select(F.col(query_id).cast("bigint").alias("id"), F.col(vector).alias("vec"))
    c = corpus.filter(F.col(vector).isNotNull()).select(F.col(corpus_id).cast("bigint").alias("id"), F.col(vector).alias("vec"))
    # The ids alone are counted, so the vectors are not read for it; one row tells the width.
    n_q, n_c = q.select("id").count(), c.select("id").count()
    head = c.select(F.size("vec")).first()
    row_bytes = 8 * max(head[0] if head else 0, 1)
    if n_c * row_bytes <= broadcast_bytes:
        return _corpus_sent(q, c, k)
    q = q.withColumn("floor", F.lit(float("-inf")))
    # A row is copied once per block of the other side: blocks as large as a task can hold keep that low.
    size = block_rows or max(BLOCK_ROWS, BLOCK_BYTES // row_bytes)
    part = GROWTH ** max(0, math.ceil(math.log(max(n_c / first_rows, 1), GROWTH)))
    while True:
        some = c.filter(F.pmod(F.xxhash64("id"), F.lit(part)) == 0) if part > 1 else c
        if n_q * row_bytes <= broadcast_bytes:
            found = _queries_sent(q, some, k)
        else:
            found = _blocks(q, some, k, math.ceil(n_q / size), max(1, math.ceil(n_c / part / size)))
        if part == 1:
            return found
        kth = F.element_at(F.reverse(F.array_sort(F.collect_list("similarity"))), k)
        floors = found.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, kth).alias("reached"))
        q = staged(q.join(floors, "id", "left").select(
            "id", "vec", F.greatest("floor", F.coalesce("reached", F.lit(float("-inf")))).alias("floor")), "floors")
        part //= GROWTH


def top_k_similar(
    queries: DataFrame, corpus: DataFrame, k: int, query_id: str, corpus_id: str,
    vector: str = "embedding", broadcast_bytes: int = BROADCAST_BYTES, block_rows: int | None = None,
    first_rows: int = FIRST_ROWS,
) -> DataFrame:
    """(query_id, corpus_id, similarity, rank): the k corpus rows with the largest dot product per query."""
    found = candidates(queries, corpus, k, query_id, corpus_id, vector, broadcast_bytes, block_rows, first_rows)
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "corpus_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def max_similarity(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, **kw) -> DataFrame:
    """(query_id, max_similarity)."""
    return top_k_similar(queries, corpus, 1, query_id, corpus_id, **kw).select(
        "query_id", F.col("similarity").alias("max_similarity")
    )


def intent_rerank(
    top: DataFrame, keep: int = fv.TOP_K_EXAMPLES, min_matches: int = fv.MIN_INTENT_MATCHES
) -> DataFrame:
    """Of each query's top rows keep those of its own intent; with fewer than ``min_matches`` of them,
    fall back to plain similarity. ``top`` has query_id, query_intent, corpus_id, corpus_intent,
    similarity; its groups are bounded by the k of the search."""
    whole = Window.partitionBy("query_id")
    same = F.coalesce(F.col("corpus_intent") == F.col("query_intent"), F.lit(False))
    by_rank = whole.orderBy(F.col("similarity").desc(), "corpus_id")
    return (
        top.withColumn("n_match", F.count_if(same).over(whole))
        .withColumn("fallback", F.col("n_match") < min_matches)
        .filter(F.col("fallback") | same)
        .withColumn("example_no", F.row_number().over(by_rank))
        .filter(F.col("example_no") <= keep)
    )


def retrieve_examples(
    queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, query_intent: str, corpus_intent: str,
    k: int = fv.TOP_K_SIMILARITY, keep: int = fv.TOP_K_EXAMPLES, **kw,
) -> DataFrame:
    """The few-shot examples of each query: top ``k`` by similarity, then the intent-aware re-rank."""
    top = top_k_similar(queries, corpus, k, query_id, corpus_id, **kw)
    labelled = top.join(
        queries.select(F.col(query_id).alias("query_id"), F.col(query_intent).alias("query_intent")), "query_id"
    ).join(corpus.select(F.col(corpus_id).alias("corpus_id"), F.col(corpus_intent).alias("corpus_intent")), "corpus_id")
    return intent_rerank(labelled, keep)


def vectors_to_compute(todo: DataFrame, cache: DataFrame, id_col: str, text_col: str, model: str) -> DataFrame:
    """Rows whose vector is not in the cache for this model and this exact text."""
    keyed = todo.withColumns({"model_version": F.lit(model), "text_hash": F.xxhash64(text_col)})
    return keyed.join(cache.select(id_col, "model_version", "text_hash"), [id_col, "model_version", "text_hash"], "left_anti")


def normalize(vector):
    """Unit-length copy of an array column; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(vector, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(x.cast("double")))


def dot(left, right):
    pairs = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def encode_column(df: DataFrame, text_col: str, encoder, vector: str = "embedding") -> DataFrame:
    """Vectors from the caller's encoder (list of texts -> array of rows), batch by batch, L2-normalised."""
    from pyspark.sql import types as T

    schema = T.StructType(df.schema.fields + [T.StructField(vector, T.ArrayType(T.FloatType()))])

    def run(batches):
        for pdf in batches:
            raw = np.asarray(encoder(pdf[text_col].tolist()), dtype=np.float32)
            norm = np.linalg.norm(raw, axis=1, keepdims=True)
            yield pdf.assign(**{vector: list(raw / np.where(norm > 0, norm, 1))})

    return df.mapInPandas(run, schema)


def build_corpus(pairs: DataFrame, vectors: DataFrame, id_col: str, min_length: int = fv.MIN_REPLY_LENGTH) -> DataFrame:
    """Substantive pairs with their vector in the same row; a pair without one stays, and the search passes it over."""
    from spark_triage.operators.pairs import substance_filter

    return substance_filter(pairs, min_length).join(vectors, id_col, "left")
