"""Ranked lexical search by hashed max-sketches and exact rescoring in order of falling bounds.

The index holds, for each document, its distinct terms (64-bit hashes) with their occurrences, and a sketch: a power of
two of coordinates, four to eight for each distinct term, where a term falls on the coordinate of its hash. A coordinate
keeps the maximum of what falls on it. Within one document the impact of a term grows with its occurrences alone, so
the maximum of the occurrences is the maximum of the impacts, whatever N and L become when documents are added; the
impact of a coordinate is worked out when it is read. One pass over the texts makes the index, and nothing is shuffled.

Items are asked in blocks of bounded size. For the documents of a batch and all items of a block, the sum over an
item's terms of weight times impact on the term's coordinate is an upper bound of the score: one matrix product for
each sketch width. An item takes documents by falling bound, scores them exactly from their terms, and stops where the
bound falls below its k-th best score; a bound that equals it is still scored, for ties.

Documents are dealt by a hash into three rounds of one 256th, one 16th and the rest. The k-th best score of a round is the
floor of the next, so about 16 k rows per item leave the tasks of a round, however many tasks there are.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spark_triage.llm import wordhash as wh
from spark_triage.llm.common import map_batches, staged, strip
from spark_triage.session import shared_folder

ROUNDS = (16, 256, 4096)  # of 4096 parts, the upper end of each round
BLOCK_ITEMS = 256
BLOCK_TERMS = 1 << 16
LEAST_WIDTH, MOST_WIDTH = 64, 1 << 14
TOP = 255  # occurrences that a coordinate can tell apart
SLICE_BYTES = 8 << 20
SCALE = 1_000_000_000

_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_INDEX = "doc_id bigint, n bigint, terms binary, times binary, sketch binary"


def term_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, distinct term, its occurrences, terms with repeats of every row in turn) of whole texts, by piece; the
    distinct terms of a row ascend."""
    for p in wh.pieces(column, lower=True, outside=_OUTSIDE):
        n = np.diff(p.words)
        doc = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((p.hashes, doc))
        h, d = p.hashes[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        first = np.flatnonzero(new)
        yield p.rows[d[first]], h[first], np.diff(np.append(first, len(h))), n


def widths(distinct: np.ndarray) -> np.ndarray:
    """Sketch width of documents: the least power of two that is four times the distinct terms, within bounds."""
    wide = 4 * np.maximum(distinct, 1)
    return np.clip(1 << np.ceil(np.log2(wide)).astype(np.int64), LEAST_WIDTH, MOST_WIDTH)


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose row i holds ``counts[i]`` of the values, one row after the other."""
    ends = np.concatenate([[0], np.cumsum(counts * values.itemsize)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, times, sketch, round) of every row with a term, written to the shared folder."""

    def run(batch):
        rows, terms, times, sketches, sizes, n = [], [], [], [], [], []
        for row, term, count, total in term_counts(batch.column("text")):
            own = np.bincount(row - (row[0] if len(row) else 0), minlength=0) if len(row) else np.zeros(0, np.int64)
            base = int(row[0]) if len(row) else 0
            some = np.flatnonzero(own)
            if not len(some):
                continue
            distinct = own[some]
            wide = widths(distinct)
            at = np.cumsum(wide) - wide
            sketch = np.zeros(int(wide.sum()), np.uint8)
            place = np.repeat(at, distinct) + (term & (np.repeat(wide, distinct) - 1).astype(np.uint64)).astype(np.int64)
            np.maximum.at(sketch, place, np.minimum(count, TOP).astype(np.uint8))
            rows.append(some + base)
            n.append(total[total > 0])
            terms.append(_binary(term.astype("<u8"), distinct))
            times.append(_binary(count.astype("<u4"), distinct))
            sketches.append(_binary(sketch, wide))
        if not rows:
            return None
        return {"doc_id": batch.column("doc_id").take(pa.array(np.concatenate(rows))), "n": np.concatenate(n).astype(np.int64),
                "terms": pa.concat_arrays(terms), "times": pa.concat_arrays(times), "sketch": pa.concat_arrays(sketches)}

    index = map_batches(strip(docs, id_col, text_col), run, _INDEX, SLICE_BYTES)
    part = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(ROUNDS[-1]))
    number = F.lit(len(ROUNDS) - 1)
    for i, end in reversed(list(enumerate(ROUNDS[:-1]))):
        number = F.when(part < end, i).otherwise(number)
    rows = index.withColumn("round", number.cast("int"))
    path = f"{shared_folder(docs.sparkSession)}/maxsketch-{uuid.uuid4().hex}"
    rows.write.partitionBy("round").parquet(path, compression="zstd")
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _values(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of a binary column in turn, where each row's begin)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw.tobytes(), kind), (ends - ends[0]) // size


class Block:
    """Items that are asked together: item i has terms ``term[ends[i]:ends[i + 1]]``, numbers of ``vocabulary``, each
    of which has a ``weight``. ``parts`` are plain arrays, which travel to the tasks."""

    def __init__(self, item: np.ndarray, ends: np.ndarray, vocabulary: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.parts = self.item, self.ends, self.vocabulary, self.term, self.weight = item, ends, vocabulary, term, weight

    @classmethod
    def of(cls, items: list[tuple[int, bytes]]) -> Block:
        own = [np.frombuffer(raw, "<u8") for _, raw in items]
        vocabulary, term = np.unique(np.concatenate(own), return_inverse=True)
        return cls(np.array([i for i, _ in items], np.int64), np.concatenate([[0], np.cumsum([len(x) for x in own], dtype=np.int64)]),
                   vocabulary, term, np.zeros(len(vocabulary), np.int64))

    def weigh(self, held: dict[int, int], documents: int) -> None:
        """``held``: in how many documents each number of the vocabulary stands."""
        for number, df in held.items():
            self.weight[number] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))

    def folded(self, width: int) -> np.ndarray:
        """(width, items): the summed weights of each item's terms on each coordinate."""
        out = np.zeros((width, len(self.item)), np.float32)
        place = (self.vocabulary[self.term] & np.uint64(width - 1)).astype(np.int64)
        np.add.at(out, (place, np.repeat(np.arange(len(self.item)), np.diff(self.ends))), self.weight[self.term])
        return out


def lengths_part(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents with n terms, in 64-bit integers unless these would run over."""
    if 90 * int(n.max(initial=0)) * documents < 1 << 63:
        return 10 + (90 * n * documents) // total
    return np.array([10 + (90 * int(x) * documents) // total for x in n], np.int64)


class Search:
    """The best documents of a block's items among the batches of one task."""

    def __init__(self, block: Block, floors: np.ndarray, documents: int, total: int, k: int):
        self.block, self.floors, self.k = block, floors.astype(np.float64), k
        self.documents, self.total = documents, total
        self.best: list[list[tuple[int, bool, int]]] = [[] for _ in floors]  # (-score, no id, id)
        self.wide: dict[int, np.ndarray] = {}
        self.scored = 0

    def bounds(self, sketch: np.ndarray, at: np.ndarray, m: np.ndarray) -> np.ndarray:
        """(documents, items): no score is above its bound."""
        width = np.diff(at)
        out = np.zeros((len(width), len(self.floors)), np.float32)
        for w in np.unique(width).tolist():
            if w not in self.wide:
                self.wide[w] = self.block.folded(w)
            rows = np.flatnonzero(width == w)
            step = max(1, (16 << 20) // (4 * w))
            for some in (rows[i : i + step] for i in range(0, len(rows), step)):
                tf = sketch[at[some][:, None] + np.arange(w)]
                impact = tf * np.float32(SCALE) / (tf * np.float32(1000) + (8 * m[some]).astype(np.float32)[:, None])
                impact[tf == TOP] = SCALE / 1000
                out[some] = impact @ self.wide[w]
        return out * np.float32(1.001)  # above what single precision can lose

    def add(self, doc: np.ndarray, no_id: np.ndarray, n: np.ndarray, terms: np.ndarray, at: np.ndarray, times: np.ndarray,
            sketch: np.ndarray, sketch_at: np.ndarray) -> None:
        m = lengths_part(n, self.documents, self.total)
        bounds = self.bounds(sketch, sketch_at, m)
        some = np.flatnonzero((bounds >= self.floors).any(1))
        if not len(some):
            return
        # the asked terms of the documents that a bound lets through
        own = np.diff(at)[some]
        place = np.repeat(at[some] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        vocabulary = self.block.vocabulary
        number = np.minimum(np.searchsorted(vocabulary, terms[place]), len(vocabulary) - 1)
        hit = vocabulary[number] == terms[place]
        row = np.repeat(np.arange(len(some)), own)[hit]
        number, tf = number[hit], times[place[hit]].astype(np.int64)
        impact = (SCALE * tf) // (1000 * tf + 8 * m[some][row])
        begin = np.searchsorted(row, np.arange(len(some) + 1))
        part = np.zeros(len(vocabulary), np.int64)
        for i in range(len(self.floors)):
            asked = self.block.term[self.block.ends[i] : self.block.ends[i + 1]]
            part[asked] = self.block.weight[asked]
            self._rescore(i, bounds[some, i], begin, number, impact, part, doc[some], no_id[some])
            part[asked] = 0

    def _rescore(self, i, bound, begin, number, impact, part, doc, no_id) -> None:
        turn = np.flatnonzero(bound >= self.floors[i])
        turn = turn[np.argsort(-bound[turn], kind="stable")]
        done, step = 0, 2 * self.k
        while done < len(turn) and bound[turn[done]] >= self.floors[i]:
            rows = turn[done : done + step]
            rows = rows[bound[rows] >= self.floors[i]]
            done, step = done + step, 2 * step
            self.scored += len(rows)
            size = begin[rows + 1] - begin[rows]
            at = np.repeat(begin[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            upto = np.concatenate([[0], np.cumsum(part[number[at]] * impact[at])])
            ends = np.cumsum(size)
            score = upto[ends] - upto[ends - size]
            keep = np.flatnonzero(score >= self.floors[i])
            if len(keep):
                best = self.best[i] + [(-int(s), bool(b), int(d)) for s, b, d in zip(score[keep], no_id[rows[keep]], doc[rows[keep]])]
                best.sort()
                self.best[i] = best[: self.k]
                if len(best) >= self.k:
                    self.floors[i] = max(self.floors[i], -self.best[i][-1][0])

    def found(self) -> pa.RecordBatch:
        rows = [(int(self.block.item[i]), None if b else d, -s) for i, best in enumerate(self.best) for s, b, d in best]
        item, doc, score = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                          ["item", "doc_id", "score"])


def _holding(index: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """In how many documents each number of ``vocabulary`` stands."""
    held = index.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            terms, _ = _values(batch.column(0), "<u8")
            at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
            total += np.bincount(at[known[at] == terms], minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["number", "df"])

    sums = index.select("terms").mapInArrow(run, "number bigint, df bigint").groupBy("number").agg(F.sum("df").alias("df"))
    return {r["number"]: r["df"] for r in sums.collect()}  # at most the terms of a block


def _best(index: DataFrame, block: Block, documents: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score) of the ``k`` best documents of each item of a block."""
    spark = index.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    floors, found = np.ones(len(block.item)), None
    place = {int(x): i for i, x in enumerate(block.item)}
    for number in range(len(ROUNDS)):
        held = spark.sparkContext.broadcast((block.parts, floors.copy(), documents, total, k))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            parts, *rest = held.value
            search = Search(Block(*parts), *rest)
            for batch in batches:
                step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
                for b in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                    terms, at = _values(b.column("terms"), "<u8")
                    times, _ = _values(b.column("times"), "<u4")
                    sketch, sketch_at = _values(b.column("sketch"), "u1")
                    doc = b.column("doc_id")
                    search.add(doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False),
                               b.column("n").to_numpy(), terms, at, times, sketch, sketch_at)
            yield search.found()

        rows = index.filter(F.col("round") == number).drop("round")
        hits = rows.mapInArrow(run, "item bigint, doc_id bigint, score bigint")
        hits = hits if found is None else hits.union(found)
        ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        found = staged(ranked.filter(F.col("rank") <= k).drop("rank"), "maxsketch-best")
        if number + 1 < len(ROUNDS):
            for r in found.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("floor")).collect():  # a block's items
                if r["n"] >= k:
                    floors[place[r["item"]]] = r["floor"]
    return found


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item, all with a score above 0 if
    there are fewer; equal scores by ascending document id, rows without an id last.

    Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A to Z folded; a null or empty
    text has none and is in no result. Every row counts, so a repeated document row is found each time and a repeated
    item row is answered each time; further columns are left out. Two terms are one if their 64-bit hashes are.
    """
    index = build_index(docs, id_col, text_col)
    sums = index.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    asked = strip(items, item_col, item_text).withColumn("item", F.monotonically_increasing_id())
    asked = staged(asked, "maxsketch-items")

    def run(batch):
        out = {}
        for row, term, _, _ in term_counts(batch.column("text")):
            for r in np.unique(row).tolist():
                out[r] = term[row == r].astype("<u8")
        if not out:
            return None
        return {"item": batch.column("item").take(pa.array(list(out))), "terms": [x.tobytes() for x in out.values()],
                "n": [len(x) for x in out.values()]}

    terms = staged(map_batches(asked, run, "item bigint, terms binary, n bigint", 1 << 20), "maxsketch-terms")
    size = terms.agg(F.count("*").alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    blocks = max(1, -(-size["items"] // block_items), -(-size["terms"] // block_terms))  # a block is about as large as that
    found = None
    for number in range(blocks if sums["n"] else 0):
        rows = terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).select("item", "terms").collect()
        if not rows:
            continue
        block = Block.of([(r["item"], bytes(r["terms"])) for r in rows])
        block.weigh(_holding(index, block.vocabulary), sums["n"])
        best = _best(index, block, sums["n"], sums["total"], k)
        found = best if found is None else found.union(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], StructType.fromDDL("item_id bigint, rank int, doc_id bigint, score bigint"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    named = found.withColumn("rank", F.row_number().over(order)).join(asked.select("item", F.col("doc_id").alias("item_id")), "item")
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
