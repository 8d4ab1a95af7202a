"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

Texts are cut into words with the space before them (``tokens``: pieces never cross such words). A block of texts
keeps, for each word in turn, its number in the block's own list of distinct words. The lists are cut by a hash of the
word and shuffled, so that all copies of a word meet in one task and the library sees it once there; the ids go back
to the block, where the numbers place them. Only the distinct words of blocks travel, never a row for each word, and
the numbers stay in a table bucketed by block, which the ids join without moving it.
Decoding looks every id up in the id-to-piece table, whose size is the vocabulary's.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage.llm import counts as ct
from spark_triage.llm import tokens as tk
from spark_triage.llm.common import staged, strip
from spark_triage.session import shared_folder

BLOCK_BYTES = 16 << 20
PARTS = 64  # word lists of a block, at most 256
PLACED_UNITS = 1 << 19  # placed at a time
#: Fixed value: the white space of the vocabulary's word pattern.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNIT = f"[{SPACE}]+(?![^{SPACE}])| ?[^{SPACE}]+|[{SPACE}]"


def join_bytes(items: list[bytes]) -> bytes:
    """Byte strings as one: their number, their sizes, their bytes."""
    return np.array([len(items), *map(len, items)], "<u4").tobytes() + b"".join(items)


def packed(items: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(join_bytes(items))


def unpacked(raw: bytes) -> list[bytes]:
    data, at, _ = split_bytes(zstandard.ZstdDecompressor().decompress(raw))
    data = data.tobytes()
    return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def split_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(bytes, offsets, number) of ``join_bytes``."""
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", n, 4)
    return np.frombuffer(raw, np.uint8, offset=4 * (n + 1)), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), n


def cut_odd(text: str, specials: list[str]) -> list[bytes]:
    """The units of a text with special strings or white space beyond ASCII."""
    out = []
    for part in re.split("(" + "|".join(map(re.escape, specials)) + ")", text) if specials else [text]:
        out.extend([part] if part in specials else re.findall(UNIT, part))
    return [u.encode() for u in out if u]


def _block_rows(texts: pa.Array, ids: list, specials: list[str], parts: int, number: str):
    """Rows (block, part, body) of some texts: the word lists by part, and as part -1 the texts in numbers."""
    words: dict[bytes, int] = {}
    codes, sizes = [], []
    for b in tk.blocks(texts, True, specials):
        own = np.array([words.setdefault(u, len(words)) for u in b.distinct], np.int64)
        code = own[b.code] if len(own) else np.zeros(0, np.int64)
        if b.odd.any():
            each = np.split(code, b.ends[1:-1])
            for i in np.flatnonzero(b.odd):
                units = cut_odd(texts[int(b.rows[i])].as_py(), specials)
                each[i] = np.array([words.setdefault(u, len(words)) for u in units], np.int64)
            code = np.concatenate(each)
            sizes.append(np.array([len(x) for x in each]))
        else:
            sizes.append(np.diff(b.ends))
        codes.append(code)
    listed = list(words)
    code = np.concatenate(codes)
    often = np.bincount(code, minlength=len(listed))
    rank = np.argsort(-often, kind="stable")  # words are numbered by falling frequency: the numbers compress best so
    number_of = np.empty(len(rank), np.int64)
    number_of[rank] = np.arange(len(rank))
    code = number_of[code]
    listed = [listed[i] for i in rank.tolist()]
    part = np.array([xxhash.xxh3_64_intdigest(u) % parts for u in listed], np.uint8)
    planes = np.stack([code >> shift & 255 for shift in (0, 8, 16, 24)]).astype(np.uint8)
    rows = [(number, -1, packed([
        planes.tobytes(), part.tobytes(), np.concatenate(sizes).astype("<u4").tobytes(), json.dumps(ids).encode()]))]
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        if cuts[p] < cuts[p + 1]:
            rows.append((number, p, packed([listed[i] for i in order[cuts[p] : cuts[p + 1]].tolist()])))
    return rows


def word_blocks(docs: DataFrame, spec: str, buckets: int, id_col: str = "doc_id", text_col: str = "text",
                parts: int = PARTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, part, body) of all texts, a table in the shared folder, bucketed by block: a block's name and numbers must
    not change afterwards."""
    specials = tk.special_strings(spec)
    if not tk.keeps_spaces(spec):
        raise ValueError("word blocks need a byte-level vocabulary")

    def run(batches):
        for batch in batches:
            column = batch.column("text").fill_null("")
            size = np.cumsum(pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            at = 0
            while at < len(column):
                to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + block_bytes, "right")))
                rows = _block_rows(column.slice(at, to - at), batch.column("doc_id").slice(at, to - at).to_pylist(),
                                   specials, parts, uuid.uuid4().hex)
                for lo in range(0, len(rows), 64):
                    some = list(zip(*rows[lo : lo + 64]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some[0]), pa.array(some[1], pa.int32()), pa.array(some[2], pa.binary())],
                        ["block", "part", "body"])
                at = to

    rows = strip(docs, id_col, text_col).mapInArrow(run, "block string, part int, body binary")
    name = f"wordtable_{uuid.uuid4().hex}"
    rows.withColumn("words", F.col("part") >= 0).write.partitionBy("words").bucketBy(buckets, "block").option(
        "compression", "none").option("path", f"{shared_folder(docs.sparkSession)}/{name}").saveAsTable(name)
    return docs.sparkSession.table(name)


def bucket_count(docs: DataFrame, text_col: str, block_bytes: int) -> int:
    """As many buckets as shuffle partitions, or more, so that a bucket holds about four blocks at most."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // (4 * block_bytes))


def encode_words(blocks: DataFrame, spec: str) -> DataFrame:
    """(block, part, body): the ids of each word list, words of one part in one task, each distinct word encoded once."""
    held = blocks.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        encoder = tk.encoder(held.value)
        for batch in batches:
            out = []
            for raw in batch.column("body").to_pylist():
                ids = encoder.units(unpacked(raw))
                out.append(packed([np.array([len(x) // 4 for x in ids], "<u4").tobytes(), b"".join(ids)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("part"), pa.array(out, pa.binary())], ["block", "part", "body"])

    return blocks.filter("words").select("block", "part", "body").repartition("part").sortWithinPartitions("part").mapInArrow(
        run, "block string, part int, body binary")


def piece_table(spec: str) -> list[bytes]:
    """The bytes of every id; an id without a piece is empty."""
    model, to_byte = json.loads(spec), ct.byte_symbols()
    pieces = dict(model["model"]["vocab"].items())
    out = [b""] * (1 + max([*pieces.values(), *(t["id"] for t in model["added_tokens"])]))
    for piece, i in pieces.items():
        out[i] = bytes(to_byte[c] for c in piece)
    for t in model["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


class Pieces:
    """The id-to-piece table for vectorised joins."""

    def __init__(self, spec: str):
        table = piece_table(spec)
        self.data = np.frombuffer(b"".join(table), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in table], dtype=np.int64)])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes of all texts in turn, where each begins)."""
        data, at = tk.gather(self.data, self.offsets, ids, ends)
        return data.tobytes(), at


def encoded(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
            parts: int = PARTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids: array of int, decoded: string), or with ``digest`` (doc_id, n_tokens, ids_sha256,
    decoded_sha256), one row per row of ``docs``.

    ``ids`` is what the library gives for the whole text without added tokens; ``decoded`` is the text of the ids.
    Null and empty texts have no ids and an empty text. Bytes that are no UTF-8 become replacement characters, as in
    the library. Rows do not depend on each other, so repeated rows and ids are no matter.
    """
    buckets = bucket_count(docs, text_col, block_bytes)
    blocks = word_blocks(docs, spec, buckets, id_col, text_col, parts, block_bytes)
    held = docs.sparkSession.sparkContext.broadcast(spec)
    ids = encode_words(blocks, spec)

    def place(text: bytes, lists: list[dict]):
        pieces = tk.per_worker(f"pieces-{hash(held.value)}", lambda: Pieces(held.value))
        planes, part, sizes, names = unpacked(text)
        part = np.frombuffer(part, np.uint8)
        size, values = np.zeros(len(part), np.int64), []
        for x in sorted(lists, key=lambda x: x["part"]):
            own, ids = unpacked(x["body"])
            size[part == x["part"]] = np.frombuffer(own, "<u4")
            values.append(np.frombuffer(ids, "<u4"))
        values = np.concatenate(values) if values else np.zeros(0, "<u4")
        # the lists stand part by part; where each word's ids begin, by word number
        order = np.argsort(part, kind="stable")
        begin = np.empty(len(part), np.int64)
        begin[order] = np.concatenate([[0], np.cumsum(size[order])])[:-1]
        planes = np.frombuffer(planes, np.uint8).reshape(4, -1)
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64)])
        names, at = json.loads(names), 0
        while at < len(names):  # some texts at a time
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + PLACED_UNITS, "right")) - 1)
            cut = planes[:, ends[at] : ends[to]].astype(np.int64)
            code = cut[0] | cut[1] << 8 | cut[2] << 16 | cut[3] << 24
            ids, first = tk.gather_at(values, begin, size, code, ends[at : to + 1] - ends[at])
            yield _result(names[at:to], ids, first, pieces, digest)
            at = to

    def placed(batches):
        for batch in batches:
            for text, lists in zip(batch.column("text"), batch.column("lists")):
                yield from place(text.as_py(), lists.as_py() or [])

    schema = ("doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digest
              else "doc_id bigint, ids array<int>, decoded string")
    texts = blocks.filter("not words").select("block", F.col("body").alias("text"))
    lists = ids.repartition(buckets, "block").groupBy("block").agg(F.collect_list(F.struct("part", "body")).alias("lists"))  # at most PARTS a block
    return texts.join(lists, "block", "left").select("text", "lists").mapInArrow(placed, schema)


def _result(names: list, ids: np.ndarray, first: np.ndarray, pieces: Pieces, digest: bool) -> pa.RecordBatch:
    """The rows of some texts, whose ids stand one after the other and begin at ``first``."""
    decoded, cut = pieces.decode(ids, first)
    texts = [decoded[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
    out = {"doc_id": pa.array(names, pa.int64())}
    if not digest:
        lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_pydict(out | {"ids": lists, "decoded": pa.array(texts, pa.string())})
    raw = ids.astype("<u4").tobytes()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return pa.RecordBatch.from_pydict(out | {
        "n_tokens": pa.array(np.diff(first)),
        "ids_sha256": pa.array([sha(raw[4 * a : 4 * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]),
        "decoded_sha256": pa.array([sha(x.encode()) for x in texts])})


def decode(ids: DataFrame, spec: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of arrays of ids, by a join of every id with the id-to-piece table; null arrays give an empty
    text, unknown ids nothing. A document's pieces meet again by a name that its row gets, so ids may repeat."""
    spark = ids.sparkSession
    table = spark.createDataFrame(list(enumerate(piece_table(spec))), "id int, piece binary")
    rows = ids.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    rows = staged(rows.withColumn("row", F.expr("uuid()")), "wordtable-ids")
    at = rows.select("row", F.posexplode("ids").alias("pos", "id")).join(F.broadcast(table), "id")  # vocabulary rows
    joined = at.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"))
    text = F.decode(F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.piece))"), "UTF-8")
    return rows.join(joined, "row", "left").select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
