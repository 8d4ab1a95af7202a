"""Token ids of whole texts by the tokenizers library, each distinct word of a batch encoded once.

Pieces of the two public BPE vocabularies never cross white space, so a text is cut into *units*: each word, with the
one space before it where the vocabulary keeps spaces, and what is left of the white space. The ids of a text are the
ids of its units in turn. Words are found and compared by hash on whole batches (``wordhash``); the library sees each
distinct unit. Full stops and the like after a letter or digit are a unit of their own, as they always begin a piece,
and where the vocabulary folds case, A to Z are folded before units are compared. A text for which this cutting would not hold (white space beyond ASCII, or a special token's string)
goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from spark_triage.llm import wordhash as wh
from spark_triage.llm.wordhash import per_worker

CACHE = 500_000  # units
KNOWN = 400_000  # units asked for as byte strings
SLICE_BYTES = 4 << 20  # of an Arrow batch
JOINED = 256  # units in one call
_ODD_SPACE = rb"\x1c|\x1d|\x1e|\x1f|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"


def read_vocabulary(path: str) -> str:
    """A tokenizer file of the tokenizers library, read on the driver; its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def keeps_spaces(spec: str) -> bool:
    """Whether white space is part of the pieces (a byte-level vocabulary) or dropped."""
    pre = json.loads(spec)["pre_tokenizer"]
    return pre["type"] == "ByteLevel" and pre["use_regex"]


def special_strings(spec: str) -> list[str]:
    return [t["content"] for t in json.loads(spec)["added_tokens"]]


@dataclass
class Block:
    """Units of some whole texts: text i has units ``ends[i]`` to ``ends[i + 1]`` of ``code``, numbers of distinct
    units. Unit u is ``raw[start[u]:stop[u]]`` and has the hash ``key[u]``. ``odd`` texts have no units."""

    rows: np.ndarray
    code: np.ndarray
    ends: np.ndarray
    odd: np.ndarray
    raw: bytes
    start: np.ndarray
    stop: np.ndarray
    key: np.ndarray

    def bytes_of(self, some: np.ndarray) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.start[some].tolist(), self.stop[some].tolist())]

    @property
    def distinct(self) -> list[bytes]:
        return self.bytes_of(np.arange(len(self.key)))

    def heads(self) -> np.ndarray:
        """The first eight bytes of each distinct unit, zeros behind a shorter one."""
        data = np.frombuffer(self.raw + bytes(8), np.uint8)
        place = np.arange(8)
        head = data[self.start[:, None] + place]
        head[place >= (self.stop - self.start)[:, None]] = 0
        return head.view(np.uint64).reshape(-1)


_STOPS = np.zeros(256, bool)
_STOPS[list(b".,!?;:")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True


def _before_stops(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Where the closing stops of each word begin, if a letter or digit stands before them; else the word's end."""
    end = stop.copy()
    for _ in range(4):
        back = (end - 1 > start) & _STOPS[data[end - 1]]
        end = end - back
    return np.where((end < stop) & _PLAIN[data[end - 1]], end, stop)


def blocks(column: pa.Array, spaces: bool, specials: list[str]):
    """The units of whole texts. ``spaces``: the vocabulary keeps white space and case; without, both are dropped."""
    # where case is folded the strings are looked for in the folded text, so that none comes to be by folding
    marks = [s.encode() if spaces else s.encode().lower() for s in specials]
    odd_at = re.compile(b"|".join([*([_ODD_SPACE] if spaces else []), *map(re.escape, marks)]) or rb"(?!)")
    for p in wh.pieces(column, lower=not spaces):
        odd = np.zeros(len(p.rows), bool)
        raw = p.data.tobytes()
        if (odd_at.search(raw) if spaces else any(m in raw for m in marks)):
            for i in range(len(p.rows)):
                odd[i] = odd_at.search(raw, int(p.begin[i]), int(p.end[i])) is not None
        words = p.words
        start, stop = p.start, p.stop
        doc = np.repeat(np.arange(len(p.rows)), np.diff(words))
        end = _before_stops(p.data, start, stop)
        cut = np.flatnonzero(end < stop)
        stops = end[cut], stop[cut], doc[cut]
        if spaces:
            begin = p.begin[doc]
            led = (start > begin) & (p.data[np.maximum(start, 1) - 1] == 0x20)
            start = start - led
            last = np.full(len(start), 0)
            same = np.zeros(len(start), bool)
            same[1:] = doc[1:] == doc[:-1]
            last = np.where(same, np.concatenate([[0], stop[:-1]]), begin)
            tight = ~led & (start - last >= 1)  # the last white character before the word stands alone
            gap_end = start - tight
            has = gap_end > last
            tail_from = p.begin.copy()
            some = np.diff(words) > 0
            tail_from[some] = stop[words[1:][some] - 1]
            tail = p.end > tail_from
            start = np.concatenate([start, stops[0], last[has], gap_end[tight], tail_from[tail]])
            stop = np.concatenate([end, stops[1], gap_end[has], gap_end[tight] + 1, p.end[tail]])
            doc = np.concatenate([doc, stops[2], doc[has], doc[tight], np.flatnonzero(tail)])
        else:
            start, stop, doc = (np.concatenate(x) for x in zip((start, end, doc), stops))
        order = np.argsort(start, kind="stable")
        start, stop, doc = start[order], stop[order], doc[order]
        if odd.any():
            keep = ~odd[doc]
            start, stop, doc = start[keep], stop[keep], doc[keep]
        ends = np.searchsorted(doc, np.arange(len(p.rows) + 1))
        key, first, code = np.unique(p.stretch_hash(start, stop), return_index=True, return_inverse=True)
        yield Block(p.rows, code, ends, odd, raw, start[first], stop[first], key)


def gather_at(values: np.ndarray, begin: np.ndarray, size: np.ndarray, code: np.ndarray, ends: np.ndarray):
    """(values of the units in turn, where each text's begin): unit c has ``size[c]`` values from ``begin[c]``."""
    own = size[code]
    total = np.concatenate([[0], np.cumsum(own, dtype=np.int64)])
    at = np.repeat(begin[code] - total[:-1], own) + np.arange(total[-1])
    return values[at], total[ends]


def gather(values: np.ndarray, offsets: np.ndarray, code: np.ndarray, ends: np.ndarray):
    """``gather_at`` for units that stand one after the other."""
    return gather_at(values, offsets[:-1], np.diff(offsets), code, ends)


class Units:
    """Ids of units in arrays, found by the units' hash and first eight bytes. Beyond ``bound`` units the half that was
    not asked for lately is forgotten."""

    RECENT = 1 << 15

    def __init__(self, bound: int):
        self.bound, self.turn, self.n, self.n_ids = bound, 0, 0, 0
        # one allocation for the life of a worker: arrays that grow piece by piece would leave holes in its memory
        self.begin, self.size, self.used = (np.zeros(bound, np.int32) for _ in range(3))
        self.pool = np.zeros(4 * bound, "<u4")
        none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.levels = [none, none]  # (hash, head, place) by hash: all but the latest, the latest

    def find(self, key: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Places of units; -1 for one that is not held."""
        out = np.full(len(key), -1, np.int32)
        for keys, heads, place in self.levels:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = (keys[at] == key) & (heads[at] == head)
                out[hit] = place[at[hit]]
        self.turn += 1
        self.used[out[out >= 0]] = self.turn
        return out

    def add(self, key: np.ndarray, head: np.ndarray, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places of new units with ``size`` ids each of ``ids``; ``key`` ascends. ``make_room`` comes first."""
        place = np.arange(self.n, self.n + len(key), dtype=np.int32)
        self.begin[place], self.size[place], self.used[place] = self.n_ids + np.cumsum(size) - size, size, self.turn
        if self.n_ids + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(ids), len(self.pool)), "<u4")])
        self.pool[self.n_ids : self.n_ids + len(ids)] = ids
        self.n, self.n_ids = self.n + len(key), self.n_ids + len(ids)
        old, new = self.levels
        new = self._merged(new, (key, head, place))
        if len(new[0]) > self.RECENT:
            old, new = self._merged(old, new), tuple(x[:0].copy() for x in new)
        self.levels = [old, new]
        return place

    @staticmethod
    def _merged(a, b):
        at = np.searchsorted(a[0], b[0])
        return tuple(np.insert(x, at, y) for x, y in zip(a, b))

    def make_room(self, n: int) -> None:
        """Room for ``n`` more units, before their places are asked for."""
        if self.n + n <= self.bound:
            return
        keys, heads, place = self._merged(*self.levels)
        stays = self.used[place] > (np.median(self.used[: self.n]) if self.n else 0)
        if stays.sum() + n > self.bound:
            stays[:] = False
        if n > self.bound:  # a piece with more units than that
            self.__init__(2 * n)
            return
        keys, heads, place = keys[stays], heads[stays], place[stays]
        ids, at = gather_at(self.pool, self.begin[place].astype(np.int64), self.size[place].astype(np.int64),
                            np.arange(len(place)), np.arange(len(place) + 1))
        size, used = self.size[place], self.used[place]
        self.n, self.n_ids = len(place), len(ids)
        self.begin[: self.n], self.size[: self.n], self.used[: self.n] = at[:-1], size, used
        self.pool[: self.n_ids] = ids
        self.levels = [(keys, heads, np.arange(self.n, dtype=np.int32)), tuple(x[:0].copy() for x in self.levels[1])]


class Encoder:
    """Ids of whole columns. Results for units are kept up to a bound."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.spaces, self.specials = keeps_spaces(spec), special_strings(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.held = Units(CACHE)
        self.known: dict[bytes, bytes] = {}
        # a mark that is a piece, and one id, wherever it stands between units
        self.mark = b"\n" if self.spaces else b" \x01 "
        self.mark_id = self.whole([self.mark.decode()])[0][0]

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of(self, units: list[bytes]) -> list[np.ndarray]:
        """Ids of each unit, many in one call with marks between them; units that hold a mark go alone."""
        mark = self.mark.strip(b" ")
        out: list = [None] * len(units)
        alone = [i for i, u in enumerate(units) if mark in u or u.isspace()]
        apart = set(alone)
        joined = [i for i in range(len(units)) if i not in apart] if alone else list(range(len(units)))
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        texts = [(self.mark.join([units[i] for i in g]) + self.mark).decode() for g in groups]
        for group, ids in zip(groups, self.whole(texts)):
            ids = np.array(ids, "<u4")
            at = np.flatnonzero(ids == self.mark_id)
            if len(at) != len(group):
                alone += group
                continue
            begin = 0
            for i, end in zip(group, at.tolist()):
                out[i] = ids[begin:end]
                begin = end + 1
        for i, ids in zip(alone, self.whole([units[i].decode() for i in alone])):
            out[i] = np.array(ids, "<u4")
        return out

    def units(self, distinct: list[bytes]) -> list[bytes]:
        """Ids of each unit as little-endian 32-bit integers."""
        if len(self.known) + len(distinct) > KNOWN:
            self.known = {}
        known = self.known
        new = [u for u in distinct if u not in known]
        known.update((u, x.tobytes()) for u, x in zip(new, self.ids_of(new)))
        return [known[u] for u in distinct]

    def places(self, b: Block) -> np.ndarray:
        """Places of a block's distinct units among those held."""
        self.held.make_room(len(b.key))
        head = b.heads()
        place = self.held.find(b.key, head)
        new = np.flatnonzero(place < 0)
        if len(new):
            ids = self.ids_of(b.bytes_of(new))
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            place[new] = self.held.add(b.key[new], head[new], size, np.concatenate(ids))
        return place

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, where each text's begin), null as empty."""
        parts, sizes = [], []
        for b in blocks(column, self.spaces, self.specials):
            place = self.places(b)
            held = self.held
            values, at = gather_at(held.pool, held.begin[place].astype(np.int64), held.size[place].astype(np.int64), b.code, b.ends)
            if b.odd.any():
                each = np.split(values, at[1:-1])
                for i in np.flatnonzero(b.odd):
                    each[i] = np.array(self.whole([column[int(b.rows[i])].as_py()])[0], "<u4")
                values, size = np.concatenate(each), np.array([len(x) for x in each])
            else:
                size = np.diff(at)
            parts.append(values)
            sizes.append(size)
        if not parts:
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])


def encoder(spec: str) -> Encoder:
    return per_worker(f"encoder-{hash(spec)}", lambda: Encoder(spec))
