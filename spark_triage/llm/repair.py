"""Cheapest repair of conversations by bidirectional Dijkstra over the edit lattice.

A lattice node is (rows passed, state); the state is what the repaired conversation ends in: nothing, system, user or
assistant. A row may be kept, given another role, or deleted, and an empty user or assistant turn may be inserted
anywhere. Two searches, from the first node and from the last, settle nodes by cost; their heaps meet, and they go on
until no crossing of equal cost can be left. Of all crossings of least cost the one whose two audits make the least
string wins. A settled node keeps its own least audit, which is enough: two cheapest ways to one node cannot be the
start of one another, as what one of them had more would be insertions, which cost.

Rows are sorted by conversation and turn over ranges of equal size, so a large conversation lies in many tasks. A task
walks its rows once and cuts them into segments of bounded rows and bytes. A conversation that lies in one segment is
repaired on the spot. Of the others each segment gives the cheapest way between any two states; a second lattice, whose
steps are whole segments, is searched by the same two heaps and says where each segment begins and which audit it takes.
"""

from __future__ import annotations

import heapq
import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage.llm.common import staged

SEGMENT_ROWS = 1024
SEGMENT_BYTES = 1 << 20
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
ACCEPTED = (NOTHING, ASSISTANT)
#: State after a turn of a role's first letter; a pair that is not here breaks the order.
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: State after the turn that a state asks for next, by an insertion or another role.
ASKED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = ("su", "ua", "au")
FAULTS = ("blank", "duplicate", "truncated")
WHITE = r"[\x20\x09-\x0D]"

Step = tuple[int, int, str]  # state afterwards, cost, letters
Ways = Callable[[int, int], Iterable[tuple[int, int, int, str]]]  # (place, state) -> (place, state, cost, letters)


def cheapest(ahead: Ways, back: Ways, source: tuple[int, int], targets: Iterable[tuple[int, int]]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest way from ``source`` to any of ``targets``, by least audit on ties.

    ``ahead`` and ``back`` give the ways out of and into a node; ways without cost must go to another place, and
    ``back`` gives, for each, the node where it begins.
    """
    found: list[dict] = [{}, {}]  # settled: node -> (cost, audit)
    heaps: list[list] = [[(0, source[0], "", source[1])], []]
    best: tuple[int, str] | None = None

    def settle(side: int, node: tuple[int, int], cost: int, audit: str) -> None:
        nonlocal best
        found[side][node] = (cost, audit)
        meets = [(node, 0, "")] + [((p, s), c, x) for p, s, c, x in (back if side else ahead)(*node)]
        for other, step, letters in meets:
            if other in found[1 - side]:
                far, rest = found[1 - side][other]
                way = (cost + step + far, rest + letters + audit if side else audit + letters + rest)
                if best is None or way < best:
                    best = way
            if other not in found[side]:
                text = letters + audit if side else audit + letters
                heapq.heappush(heaps[side], (cost + step, -other[0] if side else other[0], text, other[1]))

    for node in targets:
        settle(1, node, 0, "")
    while heaps[0] or heaps[1]:
        tops = [h[0][0] if h else None for h in heaps]
        if best is not None and (None in tops or sum(tops) > best[0]):
            break
        side = 0 if tops[1] is None or (tops[0] is not None and tops[0] <= tops[1]) else 1
        cost, place, audit, state = heapq.heappop(heaps[side])
        node = (-place if side else place, state)
        if node not in found[side]:
            settle(side, node, cost, audit)
    return best


@dataclass
class Turn:
    role: str
    text: str
    fault: str | None

    def ways(self, state: int) -> Iterator[Step]:
        if self.fault not in ("blank", "duplicate"):
            extra = TRUNCATED if self.fault == "truncated" else 0
            kept = AFTER.get((state, self.role[:1]))
            if kept is not None:
                yield kept, extra, "K"
            yield ASKED[state], RELABEL + extra, "R"
        yield state, DELETE, "D"


def row_lattice(turns: list[Turn]) -> tuple[Ways, Ways]:
    """The ways between nodes of a lattice of rows, forward and backward."""

    def ahead(i: int, state: int):
        yield i, ASKED[state], INSERT, "I"
        if i < len(turns):
            for to, cost, letter in turns[i].ways(state):
                yield i + 1, to, cost, letter

    def back(i: int, state: int):
        for origin in STATES:
            if ASKED[origin] == state:
                yield i, origin, INSERT, "I"
            if i:
                for to, cost, letter in turns[i - 1].ways(origin):
                    if to == state:
                        yield i - 1, origin, cost, letter

    return ahead, back


def step_lattice(steps: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[Ways, Ways]:
    """The same for steps that give the cheapest way between two states."""

    def ahead(i: int, state: int):
        if i < len(steps):
            for (origin, to), (cost, audit) in steps[i].items():
                if origin == state:
                    yield i + 1, to, cost, audit

    def back(i: int, state: int):
        if i:
            for (origin, to), (cost, audit) in steps[i - 1].items():
                if to == state:
                    yield i - 1, origin, cost, audit

    return ahead, back


def repair_turns(turns: list[Turn]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    return cheapest(*row_lattice(turns), (0, NOTHING), [(len(turns), s) for s in ACCEPTED])


def between_states(turns: list[Turn]) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest way through some rows from each state to each state, where there is one."""
    ahead, back = row_lattice(turns)
    ways = {(a, b): cheapest(ahead, back, (0, a), [(len(turns), b)]) for a in STATES for b in STATES if b != NOTHING or a == NOTHING}
    return {k: w for k, w in ways.items() if w is not None}


def apply_audit(turns: list[Turn], state: int, audit: str) -> tuple[list[str], int]:
    """(``role:text`` of the repaired turns, last state) of rows edited from ``state`` as ``audit`` says."""
    out, rows = [], iter(turns)
    for letter in audit:
        row = None if letter == "I" else next(rows)
        if letter == "D":
            continue
        asked = ASKED[state]
        state = AFTER[state, row.role[:1]] if letter == "K" else asked
        role = row.role if letter == "K" else ("user" if asked == USER else "assistant")
        out.append(f"{role}:{row.text if row else ''}")
    return out, state


@dataclass
class Segment:
    """Rows of one conversation that follow each other, and what is counted on them."""

    key: tuple
    turns: list[Turn] = field(default_factory=list)
    size: int = 0
    faults: dict = field(default_factory=lambda: dict.fromkeys(FAULTS, 0))
    illegal: int = 0
    seen: list = field(default_factory=list)  # first and last turn number that is not null
    distinct: int = 0
    begins: bool = True

    def add(self, has_turn: bool, number: int, turn: Turn) -> None:
        if self.turns:
            self.illegal += self.turns[-1].role[:1] + turn.role[:1] not in LEGAL
        if turn.fault:
            self.faults[turn.fault] += 1
        if has_turn:
            self.distinct += not self.seen or self.seen[1] != number
            self.seen = [self.seen[0] if self.seen else number, number]
        self.turns.append(turn)
        self.size += len(turn.text) + len(turn.role)

    def full(self, rows: int, size: int) -> bool:
        return len(self.turns) >= rows or self.size >= size

    def record(self, part: int, number: int, whole: bool) -> dict:
        cost, audit = repair_turns(self.turns) if whole else (None, None)
        ways = {} if whole else between_states(self.turns)
        return {
            "no_conv": self.key[0], "conv": self.key[1], "part": part, "number": number, "whole": whole,
            **self.faults, "illegal": self.illegal, "distinct": self.distinct,
            "low": self.seen[0] if self.seen else None, "high": self.seen[1] if self.seen else None,
            "first": self.turns[0].role[:1], "last": self.turns[-1].role[:1], "cost": cost, "audit": audit,
            "repaired": ("\n".join(apply_audit(self.turns, NOTHING, audit)[0]) or None) if whole else None,
            "ways": [{"a": a, "b": b, "cost": c, "audit": x} for (a, b), (c, x) in ways.items()],
            "turns": [] if whole else [{"role": t.role, "text": t.text, "fault": t.fault} for t in self.turns],
        }


_SEGMENT = """no_conv boolean, conv bigint, part int, number bigint, whole boolean, blank bigint, duplicate bigint,
truncated bigint, illegal bigint, distinct bigint, low bigint, high bigint, first string, last string, cost bigint,
audit string, repaired string, ways array<struct<a int, b int, cost bigint, audit string>>,
turns array<struct<role string, text string, fault string>>"""


def batches_of(records: Iterator[dict], schema: pa.Schema, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Records as Arrow batches of bounded rows and about eight segments' bytes."""
    held, size = [], 0
    for r in records:
        held.append(r)
        size += 1 + sum(len(x) for x in r.values() if isinstance(x, str)) + 64 * len(r.get("turns") or ())
        if len(held) >= rows or size >= 8 * SEGMENT_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


class Repaired(NamedTuple):
    """``measures``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation.
    ``pieces``: (conv_id, part, number, whole, repaired), the repaired turns as ``role:text`` lines in order of
    (part, number); ``repaired`` is null where nothing is left, and a ``whole`` piece is all of its conversation."""

    measures: DataFrame
    pieces: DataFrame


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the checksum of ``conv_id:turn``; nulls in text, role and
    the checked string are one space. A row that is dropped is gone."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    return rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


_ROW = ["no_conv", "conv", "has_turn", "turn", "role", "h"]


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows with their own faults, equal rows as one with a count, in ranges by conversation and turn; before a row whose
    role and text come earlier stands a marker (``n`` = 0)."""
    keyed = rows.select(
        F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copies")
    one = keyed.groupBy("no_conv", "conv", "has_turn", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    own = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
           .when(~F.col("text").rlike(rf"[.!?]{WHITE}*\z"), "truncated"))
    base = staged(one.withColumn("h", F.md5("text")).withColumn("fault", own), "repair-rows")
    when = F.struct("has_turn", "turn")
    same = ["no_conv", "conv", "role", "h"]
    first = base.groupBy(*same).agg(F.count("*").alias("c"), F.min(when).alias("first")).filter("c > 1").drop("c")
    later = base.select(*_ROW).join(first, same).filter(when > F.col("first"))
    marks = staged(later.select(*_ROW), "repair-marks")
    every = base.unionByName(marks.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    return every.repartitionByRange(*_ROW).sortWithinPartitions(*_ROW, "n")


def _segments(rows: DataFrame, segment_rows: int, segment_bytes: int) -> DataFrame:
    schema = _arrow(_SEGMENT)

    def records(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[dict]:
        held, number, first_key, marked = None, 0, None, None
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["no_conv"], r["conv"])
                if not r["n"]:
                    marked = tuple(r[c] for c in _ROW)
                    continue
                if held is not None and held.key != key:
                    yield held.record(part, number, held.begins and held.key != first_key)
                    held, number = None, 0
                if held is None:
                    first_key = first_key or key  # what stands before the first row is not known here
                    held = Segment(key)
                for copy in range(r["n"]):
                    if held.full(segment_rows, segment_bytes):
                        yield held.record(part, number, False)
                        held, number = Segment(key, begins=False), number + 1
                    again = copy or marked == tuple(r[c] for c in _ROW)
                    fault = "duplicate" if again and r["fault"] != "blank" else r["fault"]
                    held.add(r["has_turn"], r["turn"], Turn(r["role"], r["text"], fault))
        if held is not None:
            yield held.record(part, number, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from batches_of(records(batches, TaskContext.get().partitionId()), schema)

    return staged(rows.mapInArrow(run, _SEGMENT), "repair-segments")


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct")
_CHOSEN = """no_conv boolean, conv bigint, part int, number bigint, state int, chosen string, blank bigint,
duplicate bigint, truncated bigint, illegal bigint, distinct bigint, low bigint, high bigint, cost bigint, audit string"""


def joined_segments(parts: list[dict]) -> tuple[dict, list[tuple[int, str]]]:
    """(what holds for the whole conversation, each segment's first state and audit) of its segments in order."""
    out = {c: sum(p[c] for p in parts) for c in _COUNTS}
    out["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
    known = [p for p in parts if p["low"] is not None]
    out["distinct"] -= sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    steps = [{(w["a"], w["b"]): (w["cost"], w["audit"]) for w in p["ways"]} for p in parts]
    cost, audit = cheapest(*step_lattice(steps), (0, NOTHING), [(len(steps), s) for s in ACCEPTED])
    out |= {"low": known[0]["low"] if known else None, "high": known[-1]["high"] if known else None, "cost": cost, "audit": audit}
    return out, split_audit(steps, audit)


def split_audit(steps: list[dict], audit: str) -> list[tuple[int, str]]:
    """The first state and audit of each step on the way whose letters are ``audit``."""
    reached = [{(NOTHING, 0): None}]  # by step: (state, letters used) -> the one before
    for step in steps:
        now = {}
        for state, used in reached[-1]:
            for (a, b), (_, text) in step.items():
                if a == state and audit.startswith(text, used):
                    now.setdefault((b, used + len(text)), (state, used))
        reached.append(now)
    at = next((s, len(audit)) for s in ACCEPTED if (s, len(audit)) in reached[-1])
    out = []
    for now in reversed(reached[1:]):
        before = now[at]
        out.append((before[0], audit[before[1] : at[1]]))
        at = before
    return out[::-1]


def _streamed(df: DataFrame, each: Callable[[tuple, Iterator[dict]], Iterable[dict]], schema: str) -> DataFrame:
    """``each`` applied to the rows of every conversation in order of (part, number), one row at a time."""
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        by_conversation = groupby(rows, key=lambda r: (r["no_conv"], r["conv"]))
        yield from batches_of((x for key, own in by_conversation for x in each(key, own)), target)

    place = ["no_conv", "conv"]
    return df.repartition(*place).sortWithinPartitions(*place, "part", "number").mapInArrow(run, schema)


def repair(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> Repaired:
    """The cheapest repair of every conversation of (conv_id, turn, role, text[, copies]) rows.

    Rows stand in order of turn, nulls first, then role and text; ``copies`` says how often a row stands there. A row's
    first fault counts: blank, duplicate (its role and text stand earlier), truncated. Null roles and texts are one
    space, rows without conv_id are one conversation, other columns are left out, and an empty table has no
    conversations. ``gaps`` counts turn numbers missing between the least and the greatest. A conversation's audit is
    one value and has a letter for every row; its turns are never held together.
    """
    rows = conversations if "copies" in conversations.columns else conversations.withColumn("copies", F.lit(1).cast("long"))
    segments = _segments(_sorted_rows(rows), segment_rows, segment_bytes)
    open_ones = segments.filter("not whole")

    def choose(key, own):
        parts = list(own)
        total, chosen = joined_segments(parts)
        for p, (state, audit) in zip(parts, chosen):
            yield {"no_conv": key[0], "conv": key[1], "part": p["part"], "number": p["number"], "state": state, "chosen": audit, **total}
            total = {}  # what holds for the whole conversation stands once

    columns = ["no_conv", "conv", "part", "number", *_COUNTS, "low", "high", "first", "last", "ways"]
    light = open_ones.select(*columns)
    chosen = staged(_streamed(light, choose, _CHOSEN), "repair-chosen")
    joined = chosen.filter("cost is not null").drop("part", "number", "state", "chosen")
    place = ["no_conv", "conv", "part", "number"]
    repaired = open_ones.select(*place, "turns").join(chosen.select(*place, "state", "chosen"), place)
    piece = "no_conv boolean, conv bigint, part int, number bigint, repaired string"
    target = _arrow(piece)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for r in batch.to_pylist():
                    lines, _ = apply_audit([Turn(**t) for t in r["turns"]], r["state"], r["chosen"])
                    yield {k: r[k] for k in ("no_conv", "conv", "part", "number")} | {"repaired": "\n".join(lines) if lines else None}

        yield from batches_of(records(), target)

    whole = segments.filter("whole")
    one = whole.select(*place, F.lit(True).alias("whole"), "repaired")
    pieces = one.union(repaired.mapInArrow(edit, piece).select(*place, F.lit(False).alias("whole"), "repaired"))
    measures = whole.select(joined.columns).union(joined)
    conv_id = F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct"), F.lit(0)).alias("gaps")
    return Repaired(
        measures.select(conv_id, gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
        pieces.select(conv_id, "part", "number", "whole", "repaired"))


def digests(pieces: DataFrame) -> DataFrame:
    """(no_conv, conv, repaired_sha256) of the pieces of conversations. Where there is more than one piece, the hash goes
    through them in order, one at a time."""
    keyed = pieces.select(F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
                          "part", "number", "whole", "repaired")
    whole = keyed.filter("whole").select(
        "no_conv", "conv", F.sha2(F.coalesce("repaired", F.lit("")).cast("binary"), 256).alias("repaired_sha256"))

    def each(key, own):
        total, some = hashlib.sha256(), False
        for r in own:
            if r["repaired"] is not None:
                total.update(("\n" * some + r["repaired"]).encode())
                some = True
        yield {"no_conv": key[0], "conv": key[1], "repaired_sha256": total.hexdigest()}

    return whole.union(_streamed(keyed.filter("not whole"), each, "no_conv boolean, conv bigint, repaired_sha256 string"))


def repaired_digest(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Every conversation of the table, damaged and repaired, with the hash of its repaired turns; one of which no row
    is left after damage has zeros, no audit and the hash of nothing."""
    done = repair(damage(conversations), segment_rows)
    key = [F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv")]
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select("conv_id", *key)
    measures = done.measures.select(*key, *done.measures.columns[1:])
    rows = every.join(measures, ["no_conv", "conv"], "left").join(digests(done.pieces), ["no_conv", "conv"], "left")
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zero], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
