"""Token counts without tokens: byte-pair merging with a heap and a linked list.

The symbols of a word stand in a linked list; a heap holds the adjacent pairs that have a rank. The lowest rank is
popped, leftmost on ties, merged, and the two new neighbour pairs go in; an entry whose symbols have changed since is
passed over. The count is the number of symbols at the start less the number of merges.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage.llm import tokens as tk
from spark_triage.llm.common import map_batches, strip

#: Fixed value: the pattern that cuts text into words before merging, as the vocabulary defines it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, as character -> byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def merge_ranks(spec: str) -> dict[tuple[bytes, bytes], int]:
    """The merges of a byte-level vocabulary in order, as byte strings."""
    to_byte = byte_symbols()
    raw = lambda s: bytes(to_byte[c] for c in s)
    pairs = json.loads(spec)["model"]["merges"]
    pairs = [p.split(" ") if isinstance(p, str) else p for p in pairs]
    return {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}


def merged_length(word: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left of ``word`` after all merges."""
    n = len(word)
    if n < 2:
        return n
    symbol: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbol[i], symbol[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbol[i], symbol[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbol[i] != left or j >= n or symbol[j] != right:
            continue
        symbol[i], symbol[j] = left + right, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        merges += 1
        for a in (before[i], i):
            b = after[a] if a >= 0 else n
            if b < n:
                rank = ranks.get((symbol[a], symbol[b]))
                if rank is not None:
                    heapq.heappush(heap, (rank, a, symbol[a], symbol[b]))
    return n - merges


class Counter:
    """Counts for units, kept up to a bound, then forgotten."""

    def __init__(self, spec: str):
        import regex

        self.words = regex.compile(WORDS)
        self.ranks = merge_ranks(spec)
        self.specials = tk.special_strings(spec)
        self.cut = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        self.known: dict[bytes, int] = {}

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        return sum(merged_length(w.encode(), self.ranks) for w in self.words.findall(text))

    def whole(self, text: str) -> int:
        """Tokens of a text; each special string in it is one."""
        return sum(map(self.plain, self.cut.split(text))) + len(self.cut.findall(text))

    def units(self, distinct: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) + len(distinct) > tk.CACHE:
            known.clear()
        for u in distinct:
            if u not in known:
                known[u] = self.plain(u.decode())
        return np.array([known[u] for u in distinct], np.int64)


def token_counts(docs: DataFrame, spec: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``; a null text counts as empty. ``spec`` is
    a byte-level vocabulary of the tokenizers library."""
    if not tk.keeps_spaces(spec):
        raise ValueError("counts need a byte-level vocabulary")
    held = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batch):
        counter = tk.per_worker(f"counter-{hash(held.value)}", lambda: Counter(held.value))
        column, out = batch.column("text"), []
        for b in tk.blocks(column, True, counter.specials):
            total = np.concatenate([[0], np.cumsum(counter.units(b.distinct)[b.code])])
            n = total[b.ends[1:]] - total[b.ends[:-1]]
            for i in np.flatnonzero(b.odd):
                n[i] = counter.whole(column[int(b.rows[i])].as_py())
            out.append(n)
        n = np.concatenate(out)
        return {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("size"), "n_tokens": n, "over_limit": n > limit}

    rows = strip(docs, id_col, text_col).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return map_batches(rows, run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", tk.SLICE_BYTES, "counter-")
