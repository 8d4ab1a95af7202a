import hashlib
import itertools
import random
import re
import zlib

import pytest

from spark_triage.llm import repair as rp

ORDER = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """Plain damage of (conv_id, turn, role, text) rows."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faulty(rows):
    """[(role, text, fault)] of a conversation's rows in order."""
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else None if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def all_edits(rows, most):
    """Every (cost, audit, repaired) with at most ``most`` insertions that gives the order, by trying all."""

    def ways(i, inserted):
        if i == len(rows):
            yield 0, "", []
        else:
            role, text, fault = rows[i]
            for cost, audit, rest in ways(i + 1, inserted):
                extra = 3 if fault == "truncated" else 0
                yield cost + 4, "D" + audit, rest
                if fault not in ("blank", "duplicate"):
                    yield cost + extra, "K" + audit, [(role, text), *rest]
                    for other in ("user", "assistant"):
                        yield cost + extra + 3, "R" + audit, [(other, text), *rest]
        if inserted < most:
            for cost, audit, rest in ways(i, inserted + 1):
                for other in ("user", "assistant"):
                    yield cost + 3, "I" + audit, [(other, ""), *rest]

    for cost, audit, turns in ways(0, 0):
        if ORDER.fullmatch("".join(r[:1] for r, _ in turns)):
            yield cost, audit, turns


def relaxed(rows):
    """(cost, audit, repaired) by relaxing every edge of the lattice until nothing changes."""
    ask = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    label = {(0, 0): (0, "", ())}
    changed = True

    def offer(node, value):
        nonlocal changed
        if node not in label or value[:2] < label[node][:2]:
            label[node] = value
            changed = True

    while changed:
        changed = False
        for (i, s), (cost, audit, out) in list(label.items()):
            to, name = ask[s]
            offer((i, to), (cost + 3, audit + "I", (*out, (name, ""))))
            if i < len(rows):
                role, text, fault = rows[i]
                offer((i + 1, s), (cost + 4, audit + "D", out))
                if fault not in ("blank", "duplicate"):
                    extra = 3 if fault == "truncated" else 0
                    offer((i + 1, to), (cost + extra + 3, audit + "R", (*out, (name, text))))
                    if (s, role[:1]) in step:
                        offer((i + 1, step[s, role[:1]]), (cost + extra, audit + "K", (*out, (role, text))))
    return min(label[len(rows), s] for s in (0, 3) if (len(rows), s) in label)


def measured(rows):
    """conv_id -> plain result over (conv_id, turn, role, text) rows."""
    left = damaged(rows)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        turns = faulty([r[2:] for r in own])
        numbers = [r[1] for r in own if r[1] is not None]
        cost, audit, fixed = relaxed(turns)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(sum(f == kind for _, _, f in turns) for kind in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def some_rows(rng, n, faults=(None, None, "truncated", "blank", "duplicate")):
    return [(rng.choice(["system", "user", "user", "assistant", "assistant", " ", "tool"]), str(i), rng.choice(faults)) for i in range(n)]


def test_two_heaps_find_the_least_audit_of_all_edits():
    rng = random.Random(5)
    for n in (0, 1, 2, 3):
        for _ in range(40):
            rows = some_rows(rng, n)
            cost, audit, turns = min(all_edits(rows, 3))
            own = [rp.Turn(*r) for r in rows]
            assert rp.repair_turns(own) == (cost, audit)
            assert rp.apply_audit(own, rp.NOTHING, audit)[0] == [f"{r}:{t}" for r, t in turns]


def test_two_heaps_equal_relaxation():
    rng = random.Random(6)
    for _ in range(400):
        rows = some_rows(rng, rng.randint(0, 14))
        assert rp.repair_turns([rp.Turn(*r) for r in rows]) == relaxed(rows)[:2]


def test_segments_join_to_the_same_repair():
    rng = random.Random(7)
    for _ in range(150):
        rows = some_rows(rng, rng.randint(1, 18))
        turns = [rp.Turn(*r) for r in rows]
        cut = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randint(0, 4)))) if len(rows) > 1 else []
        parts = [turns[a:b] for a, b in itertools.pairwise([0, *cut, len(rows)])]
        steps = [rp.between_states(p) for p in parts]
        cost, audit = rp.cheapest(*rp.step_lattice(steps), (0, 0), [(len(steps), s) for s in rp.ACCEPTED])
        assert (cost, audit) == relaxed(rows)[:2]
        chosen = rp.split_audit(steps, audit)
        assert "".join(a for _, a in chosen) == audit
        lines = [x for p, (state, a) in zip(parts, chosen) for x in rp.apply_audit(p, state, a)[0]]
        assert lines == rp.apply_audit(turns, rp.NOTHING, audit)[0]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    texts = ["Yes.", "No!", "it stops", "", " \t", "Why? ", "a\nb.", "...", None]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice(texts))
            for c in range(60) for t in rng.sample(range(20), rng.randint(1, 9))]
    rows += [(77, t, "user" if t % 2 == 0 else "assistant", rng.choice(texts[:3]) + str(t // 3)) for t in range(700)]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (5, None, "user", "x."), (6, None, None, None)]
    rows += [(78, 3, "user", "same.")] * 40 + [(79, 0, "user", "x" * 50000 + ".")]
    return rows + [(c, 0, "user", "Gone.") for c in range(1000, 1100)]  # some lose their only row


@pytest.mark.parametrize("segment_rows", [3, 64, 1024])
def test_repair_of_tables(spark, talks, segment_rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in talks], "conv_id long, turn long, role string, text string, n int, h string")
    got = {r.conv_id: tuple(r)[1:] for r in rp.repaired_digest(df.repartition(5), segment_rows).collect()}
    want = measured(talks)
    assert set(got) == set(want)
    assert {c: (got[c], want[c]) for c in want if got[c] != want[c]} == {}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rp.repaired_digest(df).collect() == []
    assert rp.repair(df).pieces.collect() == []


def test_pieces_are_the_repaired_turns(spark, talks):
    df = spark.createDataFrame([r for r in talks if r[0] == 77], "conv_id long, turn long, role string, text string")
    pieces = sorted(rp.repair(df, segment_rows=50).pieces.collect(), key=lambda r: (r.part, r.number))
    assert len(pieces) > 5
    turns = faulty([(r[2], r[3]) for r in sorted((r for r in talks if r[0] == 77), key=lambda r: r[1])])
    lines = "\n".join(p.repaired for p in pieces if p.repaired is not None)
    assert lines == "\n".join(f"{r}:{t}" for r, t in relaxed(turns)[2])
