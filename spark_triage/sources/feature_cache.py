"""A table of text vectors kept up to date, and an encoder of hashed terms that needs no model.

A cache has one row per id and model: (id, model_version, text_hash, version, embedding). A merge encodes only the rows
whose text is not the one in the cache, unites them with it and keeps the newest; repeating a merge changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spark_triage.operators import features as ft
from spark_triage.operators.retrieval import vectors_to_compute
from spark_triage.session import fits, staged

DIMENSIONS = 256
SENT_BYTES = 64 << 20  # weights and ids up to this size go to the tasks that read the texts
SLICE_BYTES = 16 << 20  # of terms that a task looks up together
LEVELS = 16  # steps of 1 in idf, by which the weights to send are chosen


def term_weights(df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """(term, idf, idf_unseen): ln((1 + n) / (1 + df)) + 1 over the rows of ``df``; ``idf_unseen`` is for other terms."""
    counts = ft.document_counts(df, id_col, text_col, stop_words)
    n = df.agg(F.count_distinct(id_col).alias("n")).scalar()
    unseen = F.ln(F.lit(1.0) + F.col("n")) + 1
    return counts.withColumn("n", n).select(
        "term", (F.ln((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"), unseen.alias("idf_unseen"))


def _slot(digest: str, dimensions: int) -> int:
    return int(digest[:8], 16) % dimensions


def _sign(digest: str) -> int:
    return 1 if int(digest[8], 16) % 2 == 0 else -1


def _weighted(sent: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, idf, slot, sign) of what was sent; the arrays end with a zero for a term that is not there."""
    table = pa.ipc.open_stream(sent).read_all()
    return table["term"].combine_chunks(), *(np.append(table[c].to_numpy(), 0) for c in ("idf", "slot", "sign"))


def _sums(
    rows: pa.RecordBatch, known: tuple, unseen: float | None, stop_words: frozenset[str], dimensions: int
) -> tuple[pa.Array, np.ndarray, tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Of (id, terms) rows: the different ids, the sums of each in every slot over the ``_weighted`` terms, and (place of the
    id, term, tf) of the others. With ``unseen`` that is the weight of the others, and none are left.

    Occurrences of equal weight in a slot are added up with their signs before they are weighted, so opposite ones cancel
    in whatever order they come."""
    ids = rows.column(0)
    ids = pa.DictionaryArray.from_arrays(pa.array(np.arange(len(ids))), ids) if pa.types.is_nested(ids.type) else ids.dictionary_encode()
    size = pc.fill_null(pc.list_value_length(rows.column(1)), 0).to_numpy()
    found = rows.column(1).flatten().dictionary_encode()
    words, place = found.dictionary, found.indices.to_numpy()
    row = np.repeat(ids.indices.to_numpy().astype(np.int64), size)
    keep = pc.invert(pc.is_in(words, pa.array(sorted(stop_words), words.type))).to_numpy(zero_copy_only=False)
    at = pc.fill_null(pc.index_in(words, known[0]), len(known[0])).to_numpy()
    there = at < len(known[0])
    idf, slot, sign = (x[at] for x in known[1:])
    if unseen is not None:
        for i in np.flatnonzero(keep & ~there):
            digest = hashlib.md5(words[i].as_py().encode(), usedforsecurity=False).hexdigest()
            idf[i], slot[i], sign[i] = unseen, _slot(digest, dimensions), _sign(digest)
        there[:] = True

    order = np.lexsort((idf, slot))
    new = np.append(True, (np.diff(idf[order]) != 0) | (np.diff(slot[order]) != 0))[: len(order)]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1  # words of the same slot and weight are of a kind
    kinds = order[new]  # a word of each
    own = (keep & there)[place]
    key, n = np.unique((row[own] * len(kinds) + kind[place[own]]) * 2 + (sign[place[own]] > 0), return_counts=True)
    net, at = np.where(key & 1, n, -n), key >> 1
    word = kinds[at % max(1, len(kinds))]
    sums = np.bincount(at // max(1, len(kinds)) * dimensions + slot[word], net * idf[word], len(ids.dictionary) * dimensions)

    other = (keep & ~there)[place]
    key, tf = np.unique(row[other] * len(words) + place[other], return_counts=True)
    return ids.dictionary, sums.astype(float), (key // max(1, len(words)), words.take(pa.array(key % max(1, len(words)))), tf)


def hashed_vectors(
    df: DataFrame, id_col: str, text_col: str, weights: DataFrame, dimensions: int = DIMENSIONS,
    stop_words: Sequence[str] = (), sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """(id, embedding): terms hashed to ``dimensions`` slots with a sign, tf * idf added up, unit length.

    ``weights`` is ``term_weights`` of a reference table, written once, so a text has the same vector whatever rows are
    encoded with it. A text without terms has the zero vector; rows that share an id are one text. The texts are read once.
    Weights of at most ``sent_bytes`` go to the tasks, and one list of ``dimensions`` sums for each id leaves a task. Of a
    larger vocabulary the most frequent terms go to the tasks, as many as may be sent; what a text holds of the others is
    written, a row for each id and term, and meets its weights by a shuffle.
    """
    spark = df.sparkSession
    unseen = weights.agg(F.max("idf_unseen").alias("x")).first()["x"]
    unseen = 1.0 if unseen is None else unseen
    weights = weights.filter(F.col("term").isNotNull() & F.col("idf").isNotNull())
    level = F.floor(F.col("idf") * LEVELS)
    sizes = weights.groupBy(level.alias("level")).agg(F.sum(F.octet_length("term") + 40).alias("x")).orderBy("level").collect()
    fit = int((np.cumsum([r["x"] for r in sizes]) <= sent_bytes).sum())
    whole = fit == len(sizes)
    common = level <= sizes[fit - 1]["level"] if fit else F.lit(False)

    digest = F.md5("term")
    number = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10).cast("long")
    sign, slot = F.when(number(9, 1) % 2 == 0, 1).otherwise(-1), (number(1, 8) % dimensions).cast("int")
    few = weights.filter(common).select("term", "idf", slot.alias("slot"), sign.alias("sign")).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, few.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(few)
    sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())

    schema = StructType([df.schema[id_col], *StructType.fromDDL("sums array<double>, term string, tf bigint")])
    target = to_arrow_schema(schema)
    stop = frozenset(stop_words)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            known = known or _weighted(sent.value)
            step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                ids, sums, (place, term, tf) = _sums(batch.slice(at, step), known, unseen if whole else None, stop, dimensions)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * dimensions), pa.array(sums))
                for columns in ((ids, lists, pa.nulls(len(ids)), pa.nulls(len(ids))),
                                (ids.take(pa.array(place)), pa.nulls(len(place)), term, pa.array(tf))):
                    if len(columns[0]):
                        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    read = df.filter(F.col(id_col).isNotNull()).select(id_col, ft.found_terms(text_col)).mapInArrow(encode, schema)
    if whole:
        sums = read.select(id_col, F.lit(0).alias("base"), "sums")
    else:
        read = staged(read, "slot-sums")
        other = read.filter(F.col("term").isNotNull()).groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))
        met = other.join(weights.filter(~common).select("term", "idf"), "term", "left")
        sums = read.filter(F.col("term").isNull()).select(id_col, F.lit(0).alias("base"), "sums").unionByName(met.select(
            id_col, slot.alias("base"), F.array(F.col("tf") * F.coalesce("idf", F.lit(unseen)) * sign).alias("sums")))
    slots = sums.repartition(id_col).select(id_col, "base", F.posexplode("sums").alias("pos", "w")).groupBy(
        id_col, (F.col("base") + F.col("pos")).alias("slot")).agg(F.sum("w").alias("w"))
    rows = slots.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "w"))).alias("m"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = F.transform(
        F.sequence(F.lit(0), F.lit(dimensions - 1)),
        lambda i: F.when(F.col("norm") > 0, F.coalesce(F.try_element_at("m", i), F.lit(0.0)) / F.col("norm")).otherwise(0.0))
    return rows.select(id_col, unit.alias("embedding"))


def empty_cache(df: DataFrame, id_col: str) -> DataFrame:
    """A cache without rows, for the ids of ``df``."""
    return df.limit(0).select(
        id_col, F.lit("").alias("model_version"), F.lit(0).cast("long").alias("text_hash"), F.lit(0).cast("long").alias("version"),
        F.array().cast("array<double>").alias("embedding"))


def _one_text(rows: DataFrame, id_col: str, text_col: str, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """(id, text): every id once, with the greatest of its texts. Where the ids of several rows are few enough to be sent,
    only their texts move."""
    rows = rows.filter(F.col(id_col).isNotNull()).select(id_col, text_col)
    once = lambda df: df.groupBy(id_col).agg(F.max(text_col).alias(text_col))
    shared = ft.shared_ids(rows, id_col)
    if not fits(shared, id_col, sent_bytes):
        return once(rows)
    return rows.join(F.broadcast(shared), id_col, "left_anti").unionByName(once(rows.join(F.broadcast(shared), id_col, "left_semi")))


def _chosen(named: DataFrame, todo: DataFrame, id_col: str, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """The rows of ``named``, which has every id once, whose id ``todo`` has. No text moves where the ids of ``todo`` or
    those of the other rows are few enough to be sent."""
    ids = todo.select(id_col)
    if fits(ids, id_col, sent_bytes):
        return named.join(F.broadcast(ids), id_col, "left_semi")
    others = staged(named.select(id_col).join(ids, id_col, "left_anti"), "cache-kept")
    if fits(others, id_col, sent_bytes):
        return named.join(F.broadcast(others), id_col, "left_anti")
    return named.join(ids, id_col, "left_semi")


def merge_cache(
    cache: DataFrame, rows: DataFrame, id_col: str, text_col: str, model: str, version: int,
    encode: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``cache`` with the vectors of ``rows`` as they are now, one row per id and model.

    ``encode`` gives (id, embedding) for the (id, text) rows that it is handed, which are only those whose text differs
    from the cached one. The row of the highest version wins, so a merge that is repeated, or of which a part was written
    before, gives the same table. Rows without an id take no part, and ids that ``rows`` does not name stay as they were.
    """
    named = _one_text(rows, id_col, text_col)
    todo = staged(vectors_to_compute(named, cache, id_col, text_col, model).select(id_col, "model_version", "text_hash"), "cache-todo")
    fresh = encode(_chosen(named, todo, id_col)).join(todo, id_col).select(
        id_col, "model_version", "text_hash", F.lit(version).cast("long").alias("version"), "embedding")
    both = cache.unionByName(fresh)
    newest = F.max_by(F.struct("text_hash", "version", "embedding"), F.struct("version", "text_hash")).alias("r")
    return both.groupBy(id_col, "model_version").agg(newest).select(id_col, "model_version", "r.text_hash", "r.version", "r.embedding")
