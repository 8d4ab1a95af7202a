"""Words of whole texts as 64-bit hashes, whole Arrow batches at a time.

Texts stay UTF-8 bytes. A word is a maximal run without the bytes 0x20 and 0x09 to 0x0D. A polynomial prefix hash
over the bytes gives the hash of any stretch by one subtraction, so no Python object is made per word. Texts are
handled in pieces of about ``CHUNK`` bytes, cut between texts only; a longer text is a piece of its own.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD1342543DE82EF95
_U = np.uint64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def worker_state() -> dict:
    """What a Python worker keeps between tasks. Functions travel by value, so their module cannot hold it."""
    return sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__


def per_worker(name: str, make: Callable):
    """An object kept for the life of a Python worker."""
    state = worker_state()
    if name not in state:
        state[name] = make()
    return state[name]


class _Tables:
    """Powers of a base and of its inverse modulo 2**64. A worker keeps the ones for a usual piece; a longer text has
    its own, which go with it."""

    def __init__(self, name: str, base: int, usual: int):
        self.name, self.base, self.inverse, self.usual = name, base, pow(base, -1, 1 << 64), usual

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.usual:
            return _powers(self.base, n), _powers(self.inverse, n)
        up, down = per_worker(self.name, lambda: (_powers(self.base, self.usual), _powers(self.inverse, self.usual)))
        return up[:n], down[:n]


_BYTES, _WORDS = _Tables("powers of bytes", _BASE, CHUNK + 1), _Tables("powers of words", _STEP, 1 << 18)


@dataclass
class Piece:
    """Some whole texts. ``rows``: their numbers in the batch; text i is ``data[ends[i-1]:ends[i]]``; its words are
    numbers ``words[i]`` to ``words[i + 1]`` of ``start``, ``stop`` (byte places) and ``hashes``."""

    rows: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    space: np.ndarray
    prefix: np.ndarray

    def stretch_hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``start`` to ``stop``."""
        down = _BYTES.get(len(self.data) + 1)[1]
        return mix((self.prefix[stop] - self.prefix[start]) * down[start] + (stop - start).astype(np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def pieces(column: pa.Array, lower: bool = False, outside: np.ndarray = _SPACE) -> Iterator[Piece]:
    """The texts of a column in pieces; ``lower`` folds A to Z. ``outside`` tells of each byte whether it ends a word."""
    raw, offsets = buffers(column)
    n, at = len(column), 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        to = min(to, n)
        data = raw[offsets[at] : offsets[to]]
        if lower:
            data = _LOWER[data]
        ends = offsets[at : to + 1] - offsets[at]
        yield _piece(np.arange(at, to), data, ends, outside)
        at = to


def _piece(rows: np.ndarray, data: np.ndarray, ends: np.ndarray, outside: np.ndarray = _SPACE) -> Piece:
    size = len(data)
    space = outside[data]
    cut = np.zeros(size + 1, bool)  # a text begins here
    cut[ends] = True
    before = np.ones(size + 1, bool)
    before[1:] = space
    solid = np.zeros(size + 1, bool)
    solid[:-1] = ~space
    start = np.flatnonzero(solid & (before | cut))
    stop = np.flatnonzero(~before & (~solid | cut))
    up, down = _BYTES.get(size + 1)
    prefix = np.zeros(size + 1, np.uint64)
    np.cumsum((data + _U(1)) * up[:size], out=prefix[1:])
    hashes = mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))
    return Piece(rows, data, ends[:-1], ends[1:], start, stop, np.searchsorted(start, ends), hashes, space, prefix)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values; the caller drops those that cross a text."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.get(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=prefix[1:])
    return mix((prefix[width:] - prefix[:-width]) * down[: n - width + 1])


def spans(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the values from ``start`` to ``stop``, the length included."""
    n = len(hashes)
    up, down = _WORDS.get(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=prefix[1:])
    return mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64) * _U(_BASE))
