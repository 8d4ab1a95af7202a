"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature has ``positions`` symbols of 16 bits, each the low bits of a mixed minimum over the shingle set. Two sets
of Jaccard similarity s differ in a position with probability 1 - s, so at 0.85 and 64 positions more than 25 differ
with probability 6e-7. The positions are split into chunks, as many as the pigeonhole principle needs: with at most
``distance`` differing positions, some chunk has at most ``errors`` of them. Every choice of ``errors`` positions of a
chunk is left out in turn and the rest is a key, so all pairs within the distance share a key.

Pairs are not written out. Signatures that meet in a key are compared there, each with those it is not connected with
yet, and only connecting links within the distance go on; so sets that merely share some keys, as pages with one frame
do, stay apart. A key with more than ``MEMBERS`` signatures is chained instead, which connects all of them. Components of
these links are cut into blocks of bounded size, and a task holds one block, or two, with the full sets. It takes the
pairs within the distance, closest first, skips those already connected and confirms the others on the full sets, and
gives only the links that connect something. Large components go through three rounds: inside blocks, among one set of
each connected part, and between those blocks that are not yet all connected; so a tight group of any size takes linear
work. A loose group, whose members are near in signature but not linked, is compared block by block in full, as exactness
needs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage.llm import wordhash as wh
from spark_triage.llm.common import map_batches, staged, strip
from spark_triage.llm.graph import components

POSITIONS = 64
DISTANCE = 25
ERRORS = 1
MEMBERS = 4096  # signatures of a key that are compared with each other
BLOCK_ROWS = 512
BLOCK_BYTES = 16 << 20
_U = np.uint64


def _multipliers(positions: int, seed: int) -> np.ndarray:
    values = np.arange(1, positions + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)
    return wh.mix(values) | _U(1)


def masks(positions: int, distance: int, errors: int) -> list[list[int]]:
    """The positions that make up each key."""
    chunks = -(-(distance + 1) // (errors + 1))
    if chunks * (errors + 1) > positions:
        raise ValueError("too few positions for this distance and number of errors")
    cuts = [round(positions * i / chunks) for i in range(chunks + 1)]
    return [
        [p for p in range(lo, hi) if p not in gone]
        for lo, hi in zip(cuts, cuts[1:]) for gone in combinations(range(lo, hi), errors)
    ]


def shingle_sets(column: pa.Array, width: int):
    """The sorted distinct shingle hashes of every text; fewer words than ``width`` are one shingle."""
    for p in wh.pieces(column, lower=True):
        grams = wh.windows(p.hashes, width)
        short = wh.spans(p.hashes, p.words[:-1], p.words[1:]) if len(p.hashes) else None
        for i in range(len(p.rows)):
            a, b = int(p.words[i]), int(p.words[i + 1])
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                yield short[i : i + 1]
            else:
                yield np.zeros(0, np.uint64)


def _signature(values: np.ndarray, mult: np.ndarray) -> np.ndarray:
    low = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 512):
        np.minimum(low, (values[at : at + 512, None] * mult).min(0), out=low)
    return (wh.mix(low) & _U(0xFFFF)).astype(np.uint16)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
               positions: int = POSITIONS, seed: int = 7) -> DataFrame:
    """(doc_id, n_shingles, fp: 128 bits of the whole set, sig); fp and sig are null for an empty set."""

    def run(batch):
        mult = _multipliers(positions, seed)
        sizes, prints, sigs = [], [], []
        for values in shingle_sets(batch.column("text"), width):
            sizes.append(len(values))
            prints.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
            sigs.append(_signature(values, mult).tobytes() if len(values) else None)
        return {"doc_id": batch.column("doc_id"), "n_shingles": sizes, "fp": prints, "sig": sigs}

    return map_batches(strip(docs, id_col, text_col), run,
                       "doc_id bigint, n_shingles bigint, fp binary, sig binary")


class _Sets:
    """Union-find over the rows of a task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def met_in_keys(nodes: DataFrame, positions: int, distance: int, errors: int) -> DataFrame:
    """(key, a, b): sets that share a key with another. A row without ``b`` is a member of a key of at most ``MEMBERS``
    sets; one with it is an edge of the chain through a larger key's sets, in their order.

    A key that a batch holds very often is chained there and goes on once, marked, so that one shared by very many sets
    sends few rows; a marked key is chained as a whole.
    """
    groups = masks(positions, distance, errors)

    def keys(batch):
        node = batch.column("node").to_numpy()
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(len(node), positions)
        sig = sig.astype(np.uint64)
        cols = []
        for number, group in enumerate(groups):
            key = np.full(len(node), number + 1, np.uint64)
            for p in group:
                key = wh.mix(key * _U(0x10001) + sig[:, p])
            cols.append(key)
        key, who = np.concatenate(cols), np.tile(node, len(groups))
        order = np.lexsort((who, key))
        key, who = key[order], who[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(key)))
        often = np.repeat(size > MEMBERS // 2, size)
        at = np.flatnonzero(often[1:] & (key[1:] == key[:-1])) if len(key) else begin
        pairs = np.unique(np.stack([who[at], who[at + 1]], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        first = ~often
        first[begin] = True
        marked = often & first
        return {
            "key": np.concatenate([key[first], wh.mix(pairs.astype(np.uint64).sum(1))]).view(np.int64),
            "a": np.concatenate([who[first], pairs[:, 0]]),
            "b": pa.array(np.concatenate([who[first], pairs[:, 1]]),
                          mask=np.concatenate([~marked[first], np.zeros(len(pairs), bool)])),
        }

    def split(batches):
        held = None  # (key, sets, chained) of the key that the last batch ended with

        def told(key, who, chained):
            """The rows of keys that are complete, given by their sorted members and whether each stands for a chain."""
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            size = np.diff(np.append(begin, len(key)))
            large = np.repeat((size > MEMBERS) | (np.maximum.reduceat(chained, begin) if len(begin) else size > 0), size)
            member = np.repeat(size > 1, size) & ~large
            at = np.flatnonzero(large[1:] & (key[1:] == key[:-1]) & (who[1:] != who[:-1])) if len(key) else begin
            n = int(member.sum())
            out = (np.append(key[member], key[at]), np.append(who[member], who[at]), np.append(np.zeros(n, np.int64), who[at + 1] if len(at) else at))
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0]), pa.array(out[1]), pa.array(out[2], mask=np.append(np.ones(n, bool), np.zeros(len(at), bool)))],
                ["key", "a", "b"])

        for batch in batches:
            key, a = batch.column("key").to_numpy(), batch.column("a").to_numpy()
            b = batch.column("b")
            known = np.asarray(b.is_valid())
            b = b.fill_null(0).to_numpy()
            edge = known & (a != b)
            yield pa.RecordBatch.from_arrays([pa.array(x[edge]) for x in (key, a, b)], ["key", "a", "b"])
            key, a, mark = key[~edge], a[~edge], known[~edge]
            if held is not None:
                key, a, mark = (np.concatenate(x) for x in zip(held, (key, a, mark)))
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield told(key[:last], a[:last], mark[:last])
            held = key[last:], a[last:], mark[last:]
            if len(held[0]) > 2 * MEMBERS:  # too many to wait for the rest: chained so far, and the last set stands for them
                mark = np.ones(len(held[0]), bool)
                yield told(held[0], held[1], mark)
                held = held[0][-1:], held[1][-1:], mark[-1:]
        if held is not None:
            yield told(*held)

    met = map_batches(nodes.select("node", "sig"), keys, "key bigint, a bigint, b bigint")
    return staged(met.repartition("key").sortWithinPartitions("key", "a").mapInArrow(split, "key bigint, a bigint, b bigint"),
                  "neardup-keys")


def close_parts(node: np.ndarray, sig: np.ndarray, distance: int) -> tuple[list[tuple[int, int]], int]:
    """(links that connect all signatures within ``distance`` of another, signatures compared): each signature is compared
    with those after it that it is not connected with."""
    parts, found, compared = np.arange(len(node)), [], 0
    for i in range(len(node) - 1):
        rest = i + 1 + np.flatnonzero(parts[i + 1 :] != parts[i])
        compared += len(rest)
        near = rest[(sig[rest] != sig[i]).sum(1) <= distance]
        for j in near.tolist():
            if parts[j] != parts[i]:
                found.append((int(node[i]), int(node[j])))
                parts[parts == parts[j]] = parts[i]
    return found, compared


def near_by_signature(nodes: DataFrame, positions: int, distance: int, errors: int) -> DataFrame:
    """Edges (a, b) that connect all sets (node, sig) within ``distance`` of each other, and such as share a very
    frequent key."""
    met = met_in_keys(nodes, positions, distance, errors)
    asked = met.filter("b is null").select("key", F.col("a").alias("node")).join(nodes.select("node", "sig"), "node")

    def verify(batches):
        held, links = None, []
        for batch in batches:
            key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(len(node), positions)
            if held is not None:
                key, node, sig = (np.concatenate(x) for x in zip(held, (key, node, sig)))
            cuts = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1)
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                links += close_parts(node[lo:hi], sig[lo:hi], distance)[0]
            held = key[cuts[-1] :], node[cuts[-1] :], sig[cuts[-1] :]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])
                links = []
        if held is not None:
            links = close_parts(held[1], held[2], distance)[0]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])

    close = asked.select("key", "node", "sig").repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        verify, "a bigint, b bigint")
    return met.filter("b is not null").select("a", "b").unionByName(close)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * |x and y| >= percent * |x or y|, for sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _links_of(table: pa.Table, positions: int, distance: int, percent: int) -> pa.Table:
    """The connecting links of one task: inside each component if the rows have one side, else across the sides."""
    node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
    label, side = table.column("label").to_numpy(), table.column("side").to_numpy()
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(node), positions)
    raw = table.column("shingles").to_pylist()
    sets, parts, found = {}, _Sets(), []

    def values(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = np.frombuffer(raw[i], np.uint64)
        return sets[i]

    sizes = np.array([len(x) // 8 for x in raw], np.int64)
    order = np.argsort(comp, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
        sides = [rows[side[rows] == s] for s in np.unique(side[rows])]
        left, right = (sides[0], sides[1]) if len(sides) == 2 else (rows, rows)
        close = []
        for k, i in enumerate(left):
            others = right if len(sides) == 2 else rows[k + 1 :]
            others = others[label[others] != label[i]]
            small, big = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
            others = others[100 * small >= percent * big]
            far = (sig[others] != sig[i]).sum(1)
            ok = far <= distance
            if ok.any():
                close.append(np.stack([far[ok], np.full(int(ok.sum()), i), others[ok]], 1))
        if not close:
            continue
        close = np.concatenate(close)
        for _, i, j in close[np.argsort(close[:, 0], kind="stable")].tolist():
            x, y = int(label[i]), int(label[j])
            if parts.root(x) != parts.root(y) and similar(values(i), values(j), percent):
                parts.join(x, y)
                found.append((int(node[i]), int(node[j])))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _compare(rows: DataFrame, key: list[str], positions: int, distance: int, percent: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        return _links_of(table, positions, distance, percent)

    cols = ["node", "comp", "label", "side", "sig", "shingles"]
    return rows.select(*key, *[c for c in cols if c not in key]).groupBy(*key).applyInArrow(run, "a bigint, b bigint")


def _blocked(members: DataFrame, salt: int, name: str) -> DataFrame:
    """``members`` (node, comp, n_shingles, ..) with ``home`` and ``blk``: small components share a block by hash
    (home -1), large ones are cut into blocks by a hash of the node. Blocks are bounded in rows and in bytes."""
    need = lambda rows, size: F.greatest(
        F.ceil(rows / F.lit(BLOCK_ROWS)), F.ceil(size * 8 / F.lit(BLOCK_BYTES))).cast("long")
    sizes = staged(members.groupBy("comp").agg(
        need(F.count("*"), F.sum("n_shingles")).alias("blocks"), F.count("*").alias("size"),
        F.sum("n_shingles").alias("total")).filter("size > 1"), name)
    total = sizes.agg(F.coalesce(need(F.sum("size"), F.sum("total")), F.lit(1)).alias("n")).first()["n"]
    small = F.col("blocks") <= 1
    return members.join(sizes.select("comp", "blocks"), "comp").select(
        *members.columns, "blocks",
        F.when(small, F.lit(-1)).otherwise(F.col("comp")).alias("home"),
        F.when(small, F.pmod(F.xxhash64("comp"), F.lit(total)))
        .otherwise(F.pmod(F.xxhash64("node", F.lit(salt)), F.col("blocks"))).alias("blk"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    width: int = 5, positions: int = POSITIONS, distance: int = DISTANCE,
                    errors: int = ERRORS, seed: int = 7) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Linked are documents whose sets of ``width``-word shingles (A to Z folded) overlap with
    100 * intersection >= percent * union; component_id is the lowest id reachable. Null, empty and wordless texts
    have an empty set and no link. Equal sets are one node from the start, whatever their number. Rows that share an
    id count as one document: what any of them links is linked. A null id gives null component and kept.
    """
    sigs = staged(signatures(docs, id_col, text_col, width, positions, seed), "neardup-signatures")
    classes = staged(
        sigs.filter("fp is not null and doc_id is not null").groupBy("fp").agg(
            F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")),
        "neardup-classes")
    nodes = classes.select("node", "sig", "n_shingles")
    met = components(near_by_signature(nodes, positions, distance, errors), "neardup-met").withColumnRenamed("component", "comp")
    met = staged(met.join(nodes.groupBy("node").agg(F.sum("n_shingles").alias("n_shingles")), "node"), "neardup-met")

    def full(batch):
        out = list(shingle_sets(batch.column("text"), width))
        mult = _multipliers(positions, seed)
        some = [len(x) > 0 for x in out]
        keep = pa.array(some)
        return {
            "node": batch.column("doc_id").filter(keep), "shingles": [x.tobytes() for x in out if len(x)],
            "sig": [_signature(x, mult).tobytes() for x in out if len(x)],
        }

    texts = strip(docs, id_col, text_col).join(met.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = staged(map_batches(texts, full, "node bigint, shingles binary, sig binary"), "neardup-sets")

    blocks = staged(_blocked(met, 0, "neardup-sizes"), "neardup-blocks")
    rows = blocks.withColumn("label", F.col("node")).withColumn("side", F.lit(0)).join(sets, "node")
    links = staged(_compare(rows, ["home", "blk"], positions, distance, percent), "neardup-links")
    labels = staged(components(links, "neardup-labels"), "neardup-labels")

    large = blocks.filter("blocks > 1").select("node", "comp", "blk", "blocks", "n_shingles")
    if large.limit(1).count():
        labelled = lambda: large.join(labels, "node", "left").withColumn(
            "label", F.coalesce("component", "node")).drop("component")
        heads = labelled().groupBy("comp", "blk", "label").agg(F.min_by(F.struct("node", "n_shingles"), "node").alias("h"))
        heads = heads.select("h.node", "comp", "label", "h.n_shingles")
        again = _blocked(heads, 1, "neardup-sizes").withColumn("side", F.lit(0)).join(sets, "node")
        links = links.unionByName(staged(_compare(again, ["home", "blk"], positions, distance, percent), "neardup-links"))
        labels = staged(components(links, "neardup-labels"), "neardup-labels")

        state = staged(labelled(), "neardup-state")
        ends = state.groupBy("comp", "blk").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        other = ends.select("comp", F.col("blk").alias("blk2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        open_pairs = staged(
            ends.join(other, "comp").filter("blk < blk2 and least(lo, lo2) <> greatest(hi, hi2)")
            .select("comp", F.col("blk").alias("i"), F.col("blk2").alias("j")), "neardup-open")
        ask = open_pairs.select("comp", "i", "j", F.explode(F.array(
            F.struct(F.col("i").alias("blk"), F.lit(0).alias("side")),
            F.struct(F.col("j").alias("blk"), F.lit(1).alias("side")))).alias("x")).select("comp", "i", "j", "x.*")
        wide = state.join(ask, ["comp", "blk"]).join(sets, "node")
        links = links.unionByName(staged(_compare(wide, ["comp", "i", "j"], positions, distance, percent), "neardup-links"))
        labels = staged(components(links, "neardup-labels"), "neardup-labels")

    found = staged(
        classes.join(labels, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")),
        "neardup-found")
    return sigs.join(found, "fp", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
    ).withColumn("kept", F.col("doc_id") == F.col("component_id"))
