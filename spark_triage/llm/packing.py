"""Packing documents into sequences of at most ``size`` tokens by exact complements, then best fit.

Only lengths decide, so the plan is made on the counts of each length, at most ``size`` numbers whatever the input.
From the longest length down, its gap is looked up among the single lengths, the sums of pairs and the sums of triples
that are still available, and each combination that fills it exactly is taken as often as the counts allow. What no
combination fills goes by best fit, longest first, into the gap that it leaves smallest. The plan is a list of
patterns with a number of repeats; pieces are handed to it by their rank within their length, in parallel.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage.llm import tokens as tk
from spark_triage.llm.common import bucket_ranks, map_batches, staged, strip

SIZE = 1024
RANKED_ROWS = 8192


def pieces(docs: DataFrame, spec: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each text and ``end_id``, in pieces of ``size``; only the
    first piece may be shorter."""
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast(spec)

    def run(batch):
        ids, at = tk.encoder(held.value).encode(batch.column("text"))
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        end = np.array([end_id], "<u4").tobytes()
        for doc, a, b in zip(batch.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            raw = ids[a:b].tobytes() + end
            total = b - a + 1
            cut, number = 0, 0
            while cut < total:
                to = cut + ((total - cut) % size or size)
                out["doc_id"].append(doc)
                out["piece"].append(number)
                out["start"].append(cut)
                out["length"].append(to - cut)
                out["ids_crc32"].append(zlib.crc32(raw[4 * cut : 4 * to]))
                cut, number = to, number + 1
        return out

    return map_batches(strip(docs, id_col, text_col), run,
                       "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint", tk.SLICE_BYTES, "encoder-")


def _fits(gap: int, left: np.ndarray, most: int):
    """Combinations of up to ``most`` (at most three) available lengths that sum to ``gap``, longer lengths first."""
    if left[gap]:
        yield (gap,)
    if most < 2:
        return
    for a in np.flatnonzero(left[: gap])[::-1].tolist():
        b = gap - a
        if b > a:
            break
        if left[a] and left[b] and (a != b or left[a] > 1):
            yield (a, b)
    if most < 3:
        return
    lengths = np.flatnonzero(left[: gap - 1])[::-1]
    for a in lengths.tolist():
        if 3 * a < gap:
            break
        if not left[a]:
            continue
        rest = gap - a
        b = np.arange(min(a, rest - 1), (rest + 1) // 2 - 1, -1)
        for x in b[(left[b] > 0) & (left[rest - b] > 0)].tolist():
            yield (a, x, rest - x)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, how many such sequences)], using every length as often as ``counts`` says.

    Short pieces spent on exact pairs and triples may be missed by the gaps of other long pieces, so plans with
    combinations of up to three, two and one lengths are made and the one with fewest sequences is taken.
    """
    return min((_plan(counts, size, most) for most in (3, 2, 1)), key=lambda chosen: sum(n for _, n in chosen))


def _plan(counts: dict[int, int], size: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= size:
            raise ValueError(f"length {length} is outside 1..{size}")
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...]) -> None:
        need = Counter(pattern)
        n = min(int(left[x]) // k for x, k in need.items())
        if n:
            for x, k in need.items():
                left[x] -= n * k
            out.append((pattern, n))

    if left[size]:
        take((size,))
    for length in range(size - 1, 0, -1):
        if left[length]:
            for rest in _fits(size - length, left, most):
                take((length, *rest))
                if not left[length]:
                    break
    opened: dict[int, dict[tuple[int, ...], int]] = {}  # gap -> pattern -> how many
    for length in range(size - 1, 0, -1):
        n = int(left[length])
        while n:
            gaps = [g for g in opened if g >= length]
            if gaps:
                gap = min(gaps)
                pattern, m = opened[gap].popitem()
                used = min(n, m)
                if m > used:
                    opened[gap][pattern] = m - used
                if not opened[gap]:
                    del opened[gap]
                pattern = (*pattern, length)
                gap -= length
                n -= used
            else:
                each = min(size // length, n)
                used = n // each
                pattern, gap = (length,) * each, size - each * length
                n -= used * each
            opened.setdefault(gap, {})
            opened[gap][pattern] = opened[gap].get(pattern, 0) + used
    out.extend((p, n) for held in opened.values() for p, n in held.items())
    return out


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, list[tuple[int, int, int]]]:
    """By length: (first rank, first sequence, offset) of every run of repeats, in rank order."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, n in chosen:
        offset = 0
        for length in pattern:
            out.setdefault(length, []).append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return out


def pack(docs: DataFrame, spec: str, end_id: int = 2, size: int = SIZE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A document is the ids of its text and ``end_id``; a null or empty text is ``end_id`` alone. Pieces that a
    sequence holds follow each other from offset 0. Rows are told apart only by their place in the input, so repeated
    rows and ids are packed like any others; an empty table gives no rows.
    """
    cut = staged(pieces(docs, spec, end_id, size, id_col, text_col), "packing-pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= size rows
    runs = slots(plan(counts, size))
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast({  # bounded by the plan, not by the pieces
        k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in runs.items()})
    buckets = max(1, sum(counts.values()) // RANKED_ROWS)
    ranked = bucket_ranks(cut, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")],
                          F.struct("doc_id", "piece"), buckets, "rank")

    def place(batch):
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for x in np.unique(length):
            rows = np.flatnonzero(length == x)
            first, seq, off = held.value[int(x)]
            at = np.searchsorted(first, rank[rows], "right") - 1
            sequence[rows] = seq[at] + rank[rows] - first[at]
            offset[rows] = off[at]
        return {c: batch.column(c) for c in batch.schema.names if c != "rank"} | {"sequence_id": sequence, "offset": offset}

    return map_batches(ranked, place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                      "sequence_id bigint, offset bigint")
