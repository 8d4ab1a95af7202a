"""Removal of long passages that occur more than once, exact, behind a count-min prefilter.

Every window of ``width`` words has an anchor, the ``ANCHOR``-word gram of lowest hash in it, leftmost on ties. Equal
windows have equal anchors at equal places, so a window occurs at most as often as its anchor. Consecutive windows with
the same anchor are one *span*; there are about ``2 / (width - ANCHOR + 2)`` spans for each window.

First pass: a count-min sketch of ``DEPTH`` rows of 2 ** bits counters counts anchors. An anchor's counters lie in one
range of the rows, at a place of its own in each row. Each Arrow batch fills a sketch of its own, of which only counters
that are not 0 travel; the sketches are added counter by counter, a range at a time, so no machine holds one whole.
``bits`` follows from the bytes of all texts. A counter may count several anchors, so it overestimates, and what it says
of a window is never too low: none is lost.

Second pass: spans whose anchor is estimated to occur twice in every row of the sketch go on, no others; they meet their
range of counters in a shuffle. The spans that go on are grouped exactly, first whole (a span that occurs twice repeats in all its windows, found by 96 bits), then window by
window for the rest, the ends of passages, against one copy of every repeated span (96 bits). Spans that a batch holds
twice itself need no estimate and are dealt out evenly, so a passage shared by a third of all documents sends one row
for each batch.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spark_triage.llm import wordhash as wh
from spark_triage.llm.common import map_batches, staged

WIDTH = 35
ANCHOR = 12
DEPTH = 2
RANGE_BITS = 13  # counters of a range, in each row
BYTES_PER_COUNTER = 16  # of text; a span takes about 80
_U = np.uint64

# What a row stands for: one occurrence not decided yet; a sign that the key occurs; one already found repeated.
OPEN, SIGN, FOUND = 0, 1, 2
PARTIAL, FULL, FULL_SHOWN = 0, 1, 2


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchored_spans(p: wh.Piece, width: int, gram: int):
    """(anchor hash, span hash, text number in the piece, first window in the text, windows) of every span."""
    n = len(p.hashes)
    empty = np.zeros(0, np.int64)
    if n < width:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    grams = wh.windows(p.hashes, gram)
    bits = _U(max(1, int(n).bit_length()))
    packed = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    best = _sliding_min(packed, width - gram + 1) & ((_U(1) << bits) - _U(1))
    doc = np.repeat(np.arange(len(p.rows)), np.diff(p.words))
    inside = doc[: n - width + 1] == doc[width - 1 :]
    at = np.flatnonzero(inside)
    if not len(at):
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    anchor = best[at].astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    whole = wh.spans(p.hashes, start, start + count + width - 1)
    text = doc[start]
    cell = wh.mix(grams[anchor[first]] ^ _U(0x5851F42D4C957F2D))  # lowest hashes are small; counters need all bits alike
    return cell, wh.mix(whole ^ (cell * _U(3))), text, start - p.words[text], count


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, whether the sorted row begins a key, rows of its key) for rows with these keys."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    return order, new, np.repeat(size, size)


def _pack(at: np.ndarray, kind, n: np.ndarray) -> np.ndarray:
    return (at << 8) | (kind << 6) | n


def repeated(batches, keys: list[str]):
    """Batches sorted by ``keys``, each with two masks: whether another row has the row's key, and whether the row is
    the first of its key. One row is held back between batches."""
    held, held_again = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        both = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
        cols = [both.column(k).to_numpy(zero_copy_only=False) for k in keys]
        same = np.logical_and.reduce([c[1:] == c[:-1] for c in cols]) if both.num_rows > 1 else np.zeros(0, bool)
        before = np.concatenate([[held_again], same])
        after = np.concatenate([same, [False]])
        if both.num_rows > 1:
            yield both.slice(0, both.num_rows - 1), (before | after)[:-1], ~before[:-1]
        held, held_again = both.slice(both.num_rows - 1), bool(before[-1])
    if held is not None:
        yield held, np.array([held_again]), np.array([not held_again])


def _grouped(rows: DataFrame, keys: list[str], decide, schema: str) -> DataFrame:
    def run(batches):
        for batch, again, first in repeated(batches, keys):
            out = decide(batch, again, first)
            if out.num_rows:
                yield out

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def sketch_bits(text_bytes: int) -> int:
    """Counters of a row, as a power of two."""
    return min(48, max(RANGE_BITS, (text_bytes // BYTES_PER_COUNTER).bit_length()))


def ranges(anchor: np.ndarray, bits: int) -> np.ndarray:
    """The range of each anchor's counters: its highest bits."""
    return (anchor >> _U(64 - bits + RANGE_BITS)).astype(np.int64) if bits > RANGE_BITS else np.zeros(len(anchor), np.int64)


def places(anchor: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The place of each anchor's counter in the range: for row 0 the bits below the range's, for row 1 the lowest."""
    return ((anchor >> _U(64 - bits) if row == 0 else anchor) & _U((1 << RANGE_BITS) - 1)).astype(np.int64)


def partial_sketch(anchor: np.ndarray, bits: int):
    """(range, counts: binary) of the anchors of a batch: for each counter that is not 0 its row and place, and 1 or, for
    more, 2 (32 bits: row, place, two bits of count)."""
    rng = ranges(anchor, bits)
    every = np.concatenate([(rng * DEPTH + row) << RANGE_BITS | places(anchor, row, bits) for row in range(DEPTH)])
    counter, n = np.unique(every, return_counts=True)
    where = counter >> RANGE_BITS
    where //= DEPTH
    first = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(where) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(where)))
    value = ((counter - (where * DEPTH << RANGE_BITS)) << 2 | np.minimum(n, 2)).astype("<u4")
    ends = np.concatenate([[0], np.cumsum(4 * size)]).astype(np.int64)
    body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(value)])
    return where[first], body.cast(pa.binary())


def add_sketches(batches):
    """One row per range with ``flags``, a bit for each counter of its rows that has reached 2, of rows sorted by range; a
    range without such a counter gives none."""
    key, total, out = None, None, []

    def flagged():
        if key is not None and (total >= 2).any():
            out.append((key, np.packbits(total >= 2).tobytes()))

    def taken():
        rows = list(zip(*out)) or [(), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary())], ["rng", "flags"])

    for batch in batches:
        for rng, counts in zip(*(batch.column(c).to_pylist() for c in ("rng", "counts"))):
            if rng != key:
                flagged()
                key, total = rng, np.zeros(DEPTH << RANGE_BITS, np.uint8)
            value = np.frombuffer(counts, "<u4")
            place = value >> 2
            total[place] = np.minimum(total[place] + (value & 3).astype(np.uint8), 2)
        if len(out) >= 2048:
            yield taken()
    flagged()
    if out:
        yield taken()


def merged_sketch(texts: DataFrame, width: int, gram: int, bits: int) -> DataFrame:
    """(rng, flags) of all texts, written."""

    def part(batch):
        found = [anchored_spans(p, width, gram)[0] for p in wh.pieces(batch.column("text"))]
        if not any(map(len, found)):
            return None
        rng, counts = partial_sketch(np.concatenate(found), bits)
        return {"rng": rng, "counts": counts}

    parts = map_batches(texts.select("text"), part, "rng bigint, counts binary")
    merged = parts.repartition("rng").sortWithinPartitions("rng").mapInArrow(add_sketches, "rng bigint, flags binary")
    return staged(merged, "substring-sketch")


def _texts(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """(doc_id, did, h, text, row): did and h tell rows apart that share an id but not a text."""
    doc_id = F.col(id_col).cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("did"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *[F.struct(*keep).alias("row")][: len(keep)]
    ).withColumn("h", (F.crc32(F.encode("text", "UTF-8")) - F.lit(1 << 31)).cast("int"))


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


_ROWS = "anchor bigint, span bigint, two bigint, did bigint, pos bigint"  # two: 32 bits of a second hash, and h
_NAMES = ["anchor", "span", "two", "did", "pos"]


def _passing(rows: DataFrame, flags: DataFrame, bits: int) -> DataFrame:
    """The rows whose counters have reached 2 in every row of the sketch, and those that need no estimate."""
    low = 64 - bits + RANGE_BITS
    # the flags of a range stand under an anchor of the range
    own = flags.select((F.shiftleft("rng", low) if low < 64 else F.lit(0).cast("long")).alias("anchor"), "flags")
    both = rows.unionByName(own, allowMissingColumns=True)
    rng = F.when(F.shiftright("pos", 6).bitwiseAND(F.lit(3)) == FOUND, F.col("anchor")).otherwise(
        F.shiftrightunsigned("anchor", low) if low < 64 else F.lit(0).cast("long"))

    def run(batches):
        now, bit = None, None
        for batch in batches:
            mark = np.asarray(batch.column("flags").is_valid())
            pos = batch.column("pos").fill_null(0).to_numpy()
            keep = ~mark & ((pos >> 6) & 3 == FOUND)
            asks = np.flatnonzero(~keep)  # and marks, each before the rows of its range
            anchor = batch.column("anchor").to_numpy().view(np.uint64)[asks]
            key = ranges(anchor, bits)
            place = np.stack([(row << RANGE_BITS) + places(anchor, row, bits) for row in range(DEPTH)])
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            for a, b in zip(new.tolist(), np.append(new[1:], len(key)).tolist()):
                if key[a] != now:
                    now, bit = key[a], None
                if mark[asks[a]]:
                    raw = batch.column("flags")[int(asks[a])].as_py()
                    bit = np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)
                    a += 1
                if bit is not None:
                    keep[asks[a:b]] = bit[place[:, a:b]].all(0)
            if keep.any():
                yield batch.select(_NAMES).filter(pa.array(keep))

    return both.repartition(rng).sortWithinPartitions(rng, F.col("flags").isNull()).mapInArrow(run, _ROWS)


def repeated_spans(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """(did, h, at, n, state): spans whose anchor is estimated to repeat. PARTIAL ones occur once as a whole, FULL ones
    repeat, and one copy of each repeated span is FULL_SHOWN."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    bits = sketch_bits(size)
    flags = merged_sketch(texts, width, gram, bits)

    def spread_out(span, at, did):
        return wh.mix(span ^ at.astype(np.uint64) ^ (did.astype(np.uint64) << _U(20))).view(np.int64)

    def asked(batch):
        did, h = _column(batch, "did"), _column(batch, "h")
        parts = []
        for p in wh.pieces(batch.column("text")):
            cell, span, text, at, n = anchored_spans(p, width, gram)
            second = wh.spans(wh.mix(p.hashes ^ _U(0xA5A5A5A5A5A5A5A5)), at + p.words[text], at + p.words[text] + n + width - 1) if len(at) else span
            parts.append((cell, span, (second >> _U(32)).astype(np.uint32).view(np.int32), did[p.rows[text]], h[p.rows[text]], at, n))
        if not parts:
            return None
        cell, span, two, did, h, at, n = (np.concatenate(x) for x in zip(*parts))
        order, _, size = _runs(cell)
        cell, span, two, did, h, at, n = (x[order] for x in (cell, span, two, did, h, at, n))
        alone = size == 1
        return {
            "anchor": np.where(alone, cell.view(np.int64), spread_out(span, at, did)), "span": span.view(np.int64),
            "two": two.astype(np.int64) << 32 | h.astype(np.int64) & 0xFFFFFFFF, "did": did, "pos": _pack(at, np.where(alone, OPEN, FOUND), n),
        }

    rows = map_batches(texts.select("did", "h", "text"), asked, _ROWS)
    rows = _passing(rows, flags, bits)

    def gathered(batch):
        span, both, did, pos = (_column(batch, c) for c in ("span", "two", "did", "pos"))
        two, h = (both >> 32).astype(np.int32), both.astype(np.int32)
        order, new, size = _runs(span, two)
        span, two, did, h, pos = (x[order] for x in (span, two, did, h, pos))
        at, n = pos >> 8, pos & 63
        shown, alone = new & (size > 1), size == 1
        kind = np.where(alone, OPEN, np.where(shown, SIGN, FOUND))
        key = np.where(kind == FOUND, spread_out(span.view(np.uint64), at, did), span)
        return {"key": key, "two": two, "did": did, "h": h, "pos": _pack(at, kind, n)}

    def exact(batch, again, first):
        pos = _column(batch, "pos")
        kind = (pos >> 6) & 3
        twice = again | (kind != OPEN)
        state = np.where(~twice, PARTIAL, np.where(first & (kind != FOUND), FULL_SHOWN, FULL))
        return pa.RecordBatch.from_arrays(
            [batch.column("did"), batch.column("h"), pa.array((pos >> 8).astype(np.int32)),
             pa.array((pos & 63).astype(np.int32)), pa.array(state.astype(np.int32))],
            ["did", "h", "at", "n", "state"])

    spans = map_batches(rows, gathered, "key bigint, two int, did bigint, h int, pos bigint")
    return _grouped(spans, ["key", "two"], exact, "did bigint, h int, at int, n int, state int")


def repeated_windows(texts: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """(did, h, at, n): the windows of PARTIAL spans that occur elsewhere, among the windows of ``spans``."""
    asked = spans.filter(F.col("state") != FULL).groupBy("did", "h").agg(
        F.collect_set(F.struct("at", "n", "state")).alias("spans"))  # rows equal in id and text have one list

    def windows(batch):
        did, h = _column(batch, "did"), _column(batch, "h")
        lists = batch.column("spans")
        off = lists.offsets.to_numpy()
        flat = lists.values
        s_at, s_n, s_state = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        parts = []
        for p in wh.pieces(batch.column("text")):
            one = wh.windows(p.hashes, width)
            two = wh.windows(wh.mix(p.hashes ^ _U(0xA5A5A5A5A5A5A5A5)), width)
            lo, hi = off[p.rows[0]], off[p.rows[-1] + 1]
            row = np.repeat(p.rows, np.diff(off[p.rows[0] : p.rows[-1] + 2]))
            n = s_n[lo:hi]
            at = np.repeat(s_at[lo:hi], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, state = np.repeat(row, n), np.repeat(s_state[lo:hi], n)
            place = at + p.words[row - p.rows[0]]
            parts.append((one[place].view(np.int64), (two[place] >> _U(32)).astype(np.uint32).view(np.int32),
                          did[row], h[row], at, state))
        one, two, did, h, at, state = (np.concatenate(x) for x in zip(*parts))
        order, new, size = _runs(one, two)
        one, two, did, h, at, state = (x[order] for x in (one, two, did, h, at, state))
        partial = state == PARTIAL
        opened, found, sign = partial & (size == 1), partial & (size > 1), new & ~(partial & (size == 1))
        zero = np.zeros(int(sign.sum()), np.int64)
        spread = wh.mix(one[found].view(np.uint64) ^ at[found].astype(np.uint64) ^ did[found].astype(np.uint64))
        cat = np.concatenate
        return {
            "one": cat([one[opened], spread.view(np.int64), one[sign]]),
            "two": cat([two[opened], two[found], two[sign]]),
            "did": cat([did[opened], did[found], zero]), "h": cat([h[opened], h[found], zero.astype(h.dtype)]),
            "pos": cat([_pack(at[opened], OPEN, 0), _pack(at[found], FOUND, 0), zero + _pack(0, SIGN, 0)]),
        }

    def exact(batch, again, first):
        pos = _column(batch, "pos")
        kind = (pos >> 6) & 3
        keep = pa.array((kind == FOUND) | ((kind == OPEN) & again))
        pos = (pos >> 8)[np.asarray(keep)].astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column("did").filter(keep), batch.column("h").filter(keep), pa.array(pos),
             pa.array(np.ones(len(pos), np.int32))], ["did", "h", "at", "n"])

    joined = texts.select("did", "h", "text").join(asked, ["did", "h"])
    keyed = map_batches(joined, windows, "one bigint, two int, did bigint, h int, pos bigint")
    return _grouped(keyed, ["one", "two"], exact, "did bigint, h int, at int, n int")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    gram: int = ANCHOR, keep: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text), one row per row of ``docs``, and ``row``, a struct of the columns
    ``keep``, if there are any.

    A word goes if a window of ``width`` words that covers it occurs elsewhere, in any document, its own included,
    judged on the input. The kept words are joined by one space; with ``as_is`` a text that loses none stays as it was. Null and empty texts have no words and an empty kept
    text. Rows that are copies of each other, ids included, are two occurrences each. Needs 2 <= gram < width < 86.
    """
    if not 2 <= gram < width or width - gram >= 63:
        raise ValueError("needs 2 <= gram < width and width - gram < 63")
    texts = _texts(docs, id_col, text_col, keep)
    spans = staged(repeated_spans(texts, width, gram), "substring-spans")
    flags = repeated_windows(texts, spans, width).unionByName(spans.filter(F.col("state") != PARTIAL).drop("state"))
    flags = flags.groupBy("did", "h").agg(F.collect_set(F.struct("at", "n")).alias("flags"))

    def cut(batch):
        lists = batch.column("flags")
        flat = lists.flatten()
        at, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        ends = np.cumsum(sizes)
        words_of, removed, kept = [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = text.encode().split()
            gone = 0
            if sizes[i]:
                a, m = at[ends[i] - sizes[i] : ends[i]], n[ends[i] - sizes[i] : ends[i]]
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, a, 1)
                np.add.at(step, a + m + width - 1, -1)
                stay = np.cumsum(step[:-1]) == 0
                gone = int(len(words) - stay.sum())
            words_of.append(len(words))
            removed.append(gone)
            same = as_is and not gone
            kept.append(text if same else b" ".join(compress(words, stay.tolist()) if gone else words).decode())
        out = {"doc_id": batch.column("doc_id"), "n_words": words_of, "n_removed": removed, "kept_text": kept}
        return out | ({"row": batch.column("row")} if keep else {})

    schema = StructType.fromDDL("doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
    if keep:
        schema = schema.add(texts.schema["row"])

    return map_batches(texts.join(flags, ["did", "h"], "left"), cut, schema)


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
