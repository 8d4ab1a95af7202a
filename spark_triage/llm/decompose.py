"""Packing by powers of two, so that no sequence crosses a document and next to nothing is padded.

A document of n tokens is cut by the binary digits of n: n // size pieces of ``size`` tokens (a power of two), then one
piece for every digit of the rest, longest first. Each piece is a sequence of its own, so attention never sees another
document, and as its length is a power of two it needs no padding. Sequences of equal length lie in one bucket, a
folder of the written table: a training batch takes sequences of one bucket, ``tokens // length`` of them.

A document gives at most n // size + log2(size) sequences and a row depends on its own document alone, so nothing is
shuffled; a sequence's number is fixed when the table is written.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spark_triage.llm import tokens as tk
from spark_triage.llm.common import map_batches, strip
from spark_triage.session import shared_folder

SIZE = 1024
_SCHEMA = "doc_id bigint, start bigint, ids binary, doc_tokens bigint, length bigint"


def cuts(total: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents with ``total`` tokens, in order of document and start."""
    digits = [size >> k for k in range(size.bit_length())]  # size, size / 2, .. 1
    times = np.stack([total // size, *((total // d) % 2 for d in digits[1:])], axis=1)
    doc = np.repeat(np.arange(len(total)), times.sum(1))
    length = np.repeat(np.tile(np.array(digits, np.int64), len(total)), times.reshape(-1))
    ends = np.cumsum(length)
    return doc, ends - length - (np.cumsum(total) - total)[doc], length


def sequences(docs: DataFrame, spec: str, end_id: int = 0, size: int = SIZE, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(doc_id, start, ids, doc_tokens, length, sequence_id, offset), one row per sequence, written to the shared folder
    with one folder per length.

    ``ids`` are little-endian unsigned 32-bit integers; a document is the ids of its text and ``end_id``, and a null or
    empty text is ``end_id`` alone. ``offset`` is 0, as a sequence holds one piece. Rows count on their own, so repeated
    rows and null ids are packed like any others, and further columns of ``docs`` are left out; an empty table gives no
    rows. ``size`` must be a power of two.
    """
    if size < 1 or size & (size - 1):
        raise ValueError(f"size {size} is not a power of two")
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(spec)

    def run(batch):
        ids, at = tk.encoder(held.value).encode(batch.column("text"))
        ids = np.insert(ids, at[1:], np.uint32(end_id)).astype("<u4", copy=False)
        total = np.diff(at) + 1
        doc, start, length = cuts(total, size)
        bounds = np.concatenate([[0], np.cumsum(4 * length)])
        raw = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(length), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])
        return {"doc_id": batch.column("doc_id").take(pa.array(doc)), "start": start, "ids": raw.cast(pa.binary()),
                "doc_tokens": total[doc], "length": length}

    rows = map_batches(strip(docs, id_col, text_col), run, _SCHEMA, tk.SLICE_BYTES, "encoder-")
    rows = rows.withColumn("sequence_id", F.monotonically_increasing_id())
    path = f"{shared_folder(spark)}/decompose-{uuid.uuid4().hex}"
    rows.write.partitionBy("length").parquet(path, compression="zstd")
    back = spark.read.schema(StructType([f for f in rows.schema if f.name != "length"] + [rows.schema["length"]])).parquet(path)
    return back.withColumn("offset", F.lit(0).cast("long"))


def digest(rows: DataFrame) -> DataFrame:
    """``sequences`` without their ids, but with the checksum of them."""
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
