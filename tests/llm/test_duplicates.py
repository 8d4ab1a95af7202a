"""Near-duplicates, repeated passages and components against their plain versions."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spark_triage.llm import graph, neardup, substring
from spark_triage.llm import wordhash as wh
from tests.llm import brute
from tests.llm.conftest import prose


def test_words_are_found_and_told_apart(corpus):
    column = pa.array([t for _, t in corpus])
    seen = {}
    for p in wh.pieces(column):
        for k, i in enumerate(p.rows):
            a, b = p.words[k], p.words[k + 1]
            got = [bytes(p.data[x:y]).decode() for x, y in zip(p.start[a:b], p.stop[a:b])]
            assert got == brute.words(corpus[int(i)][1])
            for w, h in zip(got, p.hashes[a:b].tolist()):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("distance,errors", [(25, 1), (7, 0), (11, 2)])
def test_all_pairs_within_the_distance_share_a_key(distance, errors):
    groups = neardup.masks(64, distance, errors)
    rng = random.Random(distance)
    for _ in range(300):
        wrong = set(rng.sample(range(64), distance))
        assert any(not wrong & set(g) for g in groups)


def test_too_many_chunks_are_refused():
    with pytest.raises(ValueError):
        neardup.masks(8, 25, 1)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    nodes = {x for e in edges for x in e}
    assert got == brute.components(edges, nodes)
    assert graph.components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_near_duplicates(frame, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame).collect()}
    assert got == brute.near(corpus)


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    """A loose group: neighbours are linked, most pairs are not, and blocks are small."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 8)
    rng = random.Random(5)
    base, docs = prose(rng, 120).split(), []
    for i in range(90):
        if i % 9 == 0:
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = prose(rng, 1)
        else:
            w[rng.randrange(len(w))] = prose(rng, 1)
        docs.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.near(docs)
    assert len({c for _, c in got.values()}) > 3


def test_rows_that_share_an_id_or_have_none(spark):
    a, b = "p q r s t u v w x y z", "k l m n o p q r s t u"
    rows = [(1, a), (5, b), (5, a), (9, b), (None, a), (3, None)]
    got = sorted((r.doc_id or 0, r.component_id) for r in neardup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 1), (1, 1), (3, 3), (5, 1), (5, 1), (9, 1)] or got == [(0, 1), (1, 1), (3, 3), (5, 1), (5, 5), (9, 5)]


def test_near_duplicates_of_nothing(empty):
    assert neardup.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("members", [4, 256])
def test_signatures_within_the_distance_are_connected(spark, monkeypatch, members):
    """Against all pairs; with few members to a key most are chained, which may connect more, never less."""
    monkeypatch.setattr(neardup, "MEMBERS", members)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 16, (12, 64), dtype=np.uint16)
    sigs = []
    for i in range(300):
        row = base[i % 12].copy()
        row[rng.choice(64, rng.integers(0, 40), replace=False)] = rng.integers(0, 1 << 16, 1)
        sigs.append(row)
    nodes = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sigs)], "node long, sig binary").repartition(5)
    edges = {(r.a, r.b) for r in neardup.near_by_signature(nodes, 64, 25, 1).collect()}
    near = [(i, j) for i in range(300) for j in range(i + 1, 300) if (sigs[i] != sigs[j]).sum() <= 25]
    want, got = brute.components(near, range(300)), brute.components(edges, range(300))
    assert all(got[i] == got[j] for i, j in near)
    if members == 256:
        assert got == want and len(edges) <= 300 * 65
    few, compared = neardup.close_parts(np.arange(300), np.stack(sigs), 25)
    assert brute.components(few, range(300)) == want and len(few) == 300 - len(set(want.values()))


def test_pages_with_one_frame_stay_apart(spark):
    """Texts that share a frame of a quarter of their words, none near: they meet in keys, and no component comes of it."""
    rng = random.Random(12)
    frame = prose(rng, 60)
    docs = [(i, frame + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(90))) for i in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    sigs = neardup.signatures(df).select(F.col("doc_id").alias("node"), "sig")
    met = neardup.met_in_keys(sigs, 64, 25, 1).filter("b is null").count()
    edges = neardup.near_by_signature(sigs, 64, 25, 1)
    largest = Counter(brute.components([(r.a, r.b) for r in edges.collect()], range(800)).values()).most_common(1)[0][1]
    assert met > 100 and largest < 10
    got = neardup.near_duplicates(df).collect()
    assert all(r.component_id == r.doc_id for r in got) and len(got) == 800


def test_similarity_is_exact_at_the_threshold():
    y = np.arange(100, dtype=np.uint64)
    assert neardup.similar(y[:85], y, 85) and not neardup.similar(y[:84], y, 85)


@pytest.mark.parametrize("width,gram", [(35, 12), (6, 2), (20, 19)])
def test_without_repeats(frame, corpus, width, gram):
    got = sorted(tuple(r) for r in substring.without_repeats(frame, width=width, gram=gram).collect())
    assert got == sorted(brute.without_repeats(corpus, width))


def test_without_repeats_on_random_words(spark):
    """Few words, so that windows repeat by chance, overlap and repeat inside a document; repeated rows as well."""
    rng = random.Random(8)
    docs = [(rng.randrange(40), " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for _ in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = sorted(tuple(r) for r in substring.without_repeats(df, width=9, gram=3).collect())
    assert got == sorted(brute.without_repeats(docs, 9))


def test_passage_of_one_batch_and_of_many(spark):
    rng = random.Random(4)
    shared = prose(rng, 50)
    docs = [(i, prose(rng, 20) + " " + (shared if i % 3 else prose(rng, 50)) + " " + prose(rng, 20)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(20)
    got = sorted(tuple(r) for r in substring.without_repeats(df).collect())
    assert got == sorted(brute.without_repeats(docs))
    assert sum(r[2] for r in got) >= 200 * 50


def test_columns_kept_and_texts_as_they_are(frame, corpus):
    rows = substring.without_repeats(frame, keep=("source", "row"), as_is=True).collect()
    by = {d: t for d, t in corpus}
    assert all(r.kept_text == (by[r.doc_id] or "") for r in rows if not r.n_removed)
    assert {r.row.row for r in rows} == {2.0}


def test_without_repeats_of_nothing_and_bad_widths(empty):
    assert substring.without_repeats(empty).collect() == []
    with pytest.raises(ValueError):
        substring.without_repeats(empty, width=5, gram=5)


def test_counters_overestimate_and_sketches_add_up():
    """Any split into batches gives the flags of the whole; an anchor that occurs twice is flagged in every row, and with
    few counters so are others."""
    rng = np.random.default_rng(5)
    anchor = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2)
    anchor = np.concatenate([anchor, anchor[:5_000]])
    rng.shuffle(anchor)

    def flagged(pieces, bits):
        parts = []
        for a in pieces:
            where, counts = substring.partial_sketch(a, bits)
            parts += list(zip(where.tolist(), counts.to_pylist()))
        parts.sort(key=lambda x: x[0])
        batches = [pa.RecordBatch.from_pydict({"rng": [p[0] for p in some], "counts": pa.array([p[1] for p in some], pa.binary())})
                   for some in (parts[i : i + 7] for i in range(0, len(parts), 7))]
        return {r["rng"]: r["flags"] for b in substring.add_sketches(iter(batches)) for r in b.to_pylist()}

    value, n = np.unique(anchor, return_counts=True)
    for bits in (13, 16, 20, 24):
        whole = flagged([anchor], bits)
        assert whole == flagged(np.array_split(anchor, 9), bits)
        low = np.ones(len(value), bool)
        for row in range(substring.DEPTH):
            place = (row << substring.RANGE_BITS) + substring.places(value, row, bits)
            low &= np.array([x in whole and bool(whole[x][p >> 3] >> (7 - (p & 7)) & 1)
                             for x, p in zip(substring.ranges(value, bits).tolist(), place.tolist())])
        assert low[n > 1].all()
        share = low[n == 1].mean()
        assert share > 0.05 if bits <= 16 else share < 0.02


def test_many_rows_equal_in_id_and_text(spark):
    text = prose(random.Random(3), 120)
    rows = [(None, text)] * 3000 + [(7, text + " end")] * 10 + [(8, prose(random.Random(4), 60))]
    got = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert len(got) == 3011
    assert {r.n_removed for r in got if r.doc_id is None} == {120} and {r.n_removed for r in got if r.doc_id == 7} == {121}
    assert {r.n_removed for r in got if r.doc_id == 8} == {0}


def test_sorted_runs_over_batches():
    keys = [1, 1, 2, 3, 3, 3, 4]
    for cuts in combinations(range(1, 7), 2):
        bounds = [0, *cuts, 7]
        batches = [pa.RecordBatch.from_pydict({"k": keys[a:b]}) for a, b in zip(bounds, bounds[1:])]
        again, first = [], []
        for _, x, y in substring.repeated(iter(batches), ["k"]):
            again += x.tolist()
            first += y.tolist()
        assert again == [True, True, False, True, True, True, False]
        assert first == [True, False, True, True, False, False, True]
