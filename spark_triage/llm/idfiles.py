"""Token ids in files of fixed-width integers, in ascending id order of their documents.

A file holds some consecutive documents::

    payload  blocks of ids, each id in the fewest bits that hold the vocabulary, lowest bit first, the block filled
             up to a whole byte
    offsets  blocks + 1 times 64 bits: where each block begins in the file
    index    documents times 64 bits document id, then documents times 64 bits: ids up to the end of the document
    footer   8 bytes b"TOKIDS01"; bits per id, ids per block (32 bits each); ids, documents, blocks (64 bits each)

All numbers are little-endian; the footer stands last, so a file is written in one pass. Any range of ids is read by the blocks that hold it, each unpacked by numpy at once.
Files go through ``pyarrow.fs``, so any store that it reaches by URI will do.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_triage.llm import tokens as tk
from spark_triage.llm.common import lean_worker, map_batches, staged, strip
from spark_triage.session import shared_folder

MAGIC = b"TOKIDS01"
HEAD = "<8sIIQQQ"
BLOCK_IDS = 4096
FILE_BYTES = 32 << 20  # of text
LOWEST = -(1 << 63)


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits % 8 == 0:  # whole bytes
        return ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(wide[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack_bits(raw: bytes, n: int, bits: int) -> np.ndarray:
    if bits % 8 == 0:
        out = np.zeros((n, 4), np.uint8)
        out[:, : bits // 8] = np.frombuffer(raw, np.uint8).reshape(n, bits // 8)
        return out.view("<u4").reshape(-1)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """Writes one file; only whole blocks and the index are held in memory."""

    def __init__(self, uri: str, bits: int, block_ids: int = BLOCK_IDS):
        self.uri, self.bits, self.block_ids = uri, bits, block_ids
        store, path = _open(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(path)
        self.rest, self.n = [], 0
        self.docs: list[int] = []
        self.ends: list[int] = []
        self.blocks = [0]
        self.waiting = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.rest.append(ids)
        self.n += len(ids)
        self.waiting += len(ids)
        self.docs.append(doc_id)
        self.ends.append(self.n)
        if self.waiting >= 64 * self.block_ids:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, "<u4")
        stop = len(ids) if all_of_it else len(ids) // self.block_ids * self.block_ids
        for at in range(0, stop, self.block_ids):
            raw = pack_bits(ids[at : min(at + self.block_ids, stop)], self.bits)
            self.out.write(raw)
            self.blocks.append(self.blocks[-1] + len(raw))
        self.rest, self.waiting = [ids[stop:]], len(ids) - stop

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.array(self.blocks, "<u8").tobytes())
        self.out.write(np.array(self.docs, "<i8").tobytes() + np.array(self.ends, "<u8").tobytes())
        self.out.write(struct.pack(HEAD, MAGIC, self.bits, self.block_ids, self.n, len(self.docs), len(self.blocks) - 1))
        self.out.close()


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str):
        store, path = _open(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        magic, self.bits, self.block_ids, self.n, docs, blocks = struct.unpack(
            HEAD, self._at(size - struct.calcsize(HEAD), struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no id file")
        index = size - struct.calcsize(HEAD) - 16 * docs
        self.docs = np.frombuffer(self._at(index, 8 * docs), "<i8")
        self.ends = np.frombuffer(self._at(index + 8 * docs, 8 * docs), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self._at(index - 8 * (blocks + 1), 8 * (blocks + 1)), "<u8").astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi`` of the file, from the blocks that hold them."""
        if hi <= lo:
            return np.zeros(0, "<u4")
        first, last = lo // self.block_ids, (hi - 1) // self.block_ids
        raw = self._at(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        out = []
        for b in range(first, last + 1):
            n = min(self.block_ids, self.n - b * self.block_ids)
            a = int(self.offsets[b] - self.offsets[first])
            out.append(unpack_bits(raw[a : a + int(self.offsets[b + 1] - self.offsets[b])], n, self.bits))
        return np.concatenate(out)[lo - first * self.block_ids : hi - first * self.block_ids]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.ends[number - 1]) if number else 0, int(self.ends[number]))

    def close(self) -> None:
        self.file.close()


def write_ids(docs: DataFrame, spec: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text",
              file_bytes: int = FILE_BYTES, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(number, uri, n_ids, n_docs) of the files written to ``folder``, a written table itself.

    Files follow each other in ascending document id; a null id comes first, rows that share an id stand together.
    Texts are dealt to ranges of (id, hash of the text), so rows of one id may lie in many; a task sorts its range,
    encodes it a few megabytes at a time and begins a new file where the next document would carry the texts of the
    file above ``file_bytes``. A document is never cut, so a longer one is a file of its own. A task that is repeated
    writes files of other names, and only those that the table names count.
    """
    import json

    rows = strip(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(LOWEST)))
    rows = rows.withColumn("mix", F.xxhash64("text")).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    held = docs.sparkSession.sparkContext.broadcast(spec)
    model = json.loads(spec)
    bits = bits_for(1 + max([*model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"]), end_id]))
    name = f"{folder.rstrip('/')}/ids-{uuid.uuid4().hex}"
    end = np.array([end_id], "<u4")

    def finish(out, part, number):
        out.close()
        return pa.RecordBatch.from_pydict(
            {"number": pa.array([part << 32 | number], pa.int64()), "uri": [out.uri], "n_ids": pa.array([out.n], pa.int64()),
             "n_docs": pa.array([len(out.docs)], pa.int64())})

    def write(batches):
        from pyspark import TaskContext

        lean_worker("encoder-")
        encoder, part = tk.encoder(held.value), TaskContext.get().partitionId()
        out, number, text_bytes = None, 0, 0
        for batch in batches:
            step = max(1, batch.num_rows * tk.SLICE_BYTES // max(1, batch.nbytes))
            for some in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                ids, at = encoder.encode(some.column("text"))
                at = at.tolist()
                for i, (doc, size) in enumerate(zip(some.column("doc_id").to_pylist(), some.column("size").to_pylist())):
                    if out is not None and text_bytes + size > file_bytes:
                        yield finish(out, part, number)
                        out, number, text_bytes = None, number + 1, 0
                    if out is None:
                        out = Writer(f"{name}/{part:06d}-{number:06d}-{uuid.uuid4().hex}.ids", bits, block_ids)
                    out.add(doc, np.concatenate([ids[at[i] : at[i + 1]], end]))
                    text_bytes += size
        if out is not None:
            yield finish(out, part, number)

    order = ["doc_id", "mix"]
    written = rows.repartitionByRange(max(1, -(-total // file_bytes)), *order).sortWithinPartitions(*order, "text").mapInArrow(
        write, "number bigint, uri string, n_ids bigint, n_docs bigint")
    return staged(written, "idfiles")


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files that ``write_ids`` names; start counts the ids of all
    documents before, over all files."""
    group = F.shiftright("number", 42)  # 1024 ranges
    sums = files.groupBy(group.alias("g")).agg(F.sum("n_ids").alias("n"))
    upto = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)  # one row for 1024 ranges
    first = sums.select("g", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy("g").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("g", group).join(first, "g").select(
        "uri", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base"))

    def read(batches):
        lean_worker()
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist()):
                f = Reader(uri)
                starts = np.concatenate([[0], f.ends[:-1]])
                at = 0
                while at < len(f.docs):  # some documents at a time
                    to = max(at + 1, int(np.searchsorted(f.ends, starts[at] + (1 << 20), "right")))
                    raw = f.ids(int(starts[at]), int(f.ends[to - 1])).tobytes()
                    cut = 4 * (np.append(starts[at:to], f.ends[to - 1]) - starts[at])
                    doc = f.docs[at:to]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc, mask=doc == LOWEST), "start": pa.array(starts[at:to] + base),
                        "n_tokens": pa.array(np.diff(cut) // 4),
                        "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.int64())})
                    at = to
                f.close()

    n = max(1, files.count())
    return placed.repartition(n).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, spec: str, end_id: int = 2, folder: str | None = None, **options) -> DataFrame:
    """What ``read_ids`` gives for the files written from ``docs``; without ``folder`` they go to the shared one."""
    return read_ids(write_ids(docs, spec, end_id, folder or shared_folder(docs.sparkSession), **options))
