import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_triage.operators import retrieval as rt


def unit(n, dim, seed):
    m = np.random.default_rng(seed).normal(size=(n, dim))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def data(spark):
    q, c = unit(37, 8, 1), unit(150, 8, 2)
    c[50:100] = c[50]  # a third of the corpus is one vector
    q[3] = c[50]
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in v], i % 4) for i, v in enumerate(m)],
                                            "id bigint, embedding array<double>, intent int").repartition(3)
    return q, c, frame(q), frame(c)


LAYOUTS = {"corpus sent": {}, "queries sent": {"broadcast_bytes": 37 * 64}, "blocks": {"broadcast_bytes": 0, "block_rows": 20},
           "queries sent, with floors": {"broadcast_bytes": 37 * 64, "first_rows": 5},
           "blocks, with floors": {"broadcast_bytes": 0, "block_rows": 20, "first_rows": 20}}


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("k", [1, 5, 200])
def test_top_k_matches_brute_force(data, layout, k):
    q, c, qf, cf = data
    got = rt.top_k_similar(qf, cf, k, "id", "id", **LAYOUTS[layout]).collect()
    sims = np.round(q @ c.T, rt.DECIMALS)
    want = set()
    for i in range(len(q)):
        for rank, j in enumerate(sorted(range(len(c)), key=lambda j: (-sims[i, j], j))[:k], 1):
            want.add((i, j, rank))
    assert {(r.query_id, r.corpus_id, r["rank"]) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("wide", [False, True])
def test_floors_bound_what_the_tasks_give(spark, wide):
    q, c = unit(20, 8, 3), unit(6000, 8, 4)
    frame = lambda m, n: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)],
                                               "id bigint, embedding array<double>").repartition(n)
    layout = {"broadcast_bytes": 0, "block_rows": 100} if wide else {"broadcast_bytes": 20 * 64}
    qf, cf = frame(q, 2), frame(c, 60)
    without = rt.candidates(qf, cf, 5, "id", "id", first_rows=10**6, **layout).count()
    floored = rt.candidates(qf, cf, 5, "id", "id", first_rows=400, **layout)
    assert without == 20 * 5 * 60 and floored.count() < 20 * 5 * 24
    got = {(r.query_id, r.corpus_id) for r in rt.top_k_similar(qf, cf, 5, "id", "id", first_rows=400, **layout).collect()}
    assert got == {(i, int(j)) for i, s in enumerate(q @ c.T) for j in np.argsort(-s)[:5]}


def test_ties_inside_a_large_block(data, monkeypatch):
    q, c, qf, cf = data
    monkeypatch.setattr(rt, "BLOCK_ROWS", 16)
    best = rt._block_top_k(np.arange(len(q)), q, np.arange(len(c)), c, 3)
    assert best[best.query_id == 3].corpus_id.tolist() == [50, 51, 52]


def test_a_pair_of_blocks_needs_little_memory():
    q, c = unit(2048, 64, 5), unit(8192, 64, 6)
    tracemalloc.start()
    best = rt._block_top_k(np.arange(len(q)), q, np.arange(len(c)), c, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20 and len(best) == 20 * len(q)
    assert best[best["query_id"] == 7].corpus_id.tolist() == np.argsort(-(c @ q[7]))[:20].tolist()


def test_max_similarity_and_empty_corpus(data):
    q, c, qf, cf = data
    got = {r.query_id: r.max_similarity for r in rt.max_similarity(qf, cf, "id", "id").collect()}
    assert [got[i] for i in range(len(q))] == pytest.approx((q @ c.T).max(1), abs=1e-8)
    assert rt.top_k_similar(qf, cf.limit(0), 3, "id", "id").count() == 0


def test_intent_rerank_and_fallback(spark):
    rows = [(1, 7, i, 7 if i in (2, 5, 9, 11) else 1, 1 - i / 100) for i in range(20)]
    rows += [(2, 7, i, 7 if i in (4, 6) else 1, 1 - i / 100) for i in range(20)]
    rows += [(3, 7, 0, 1, 0.5), (3, 7, 1, 1, 0.4)]
    top = spark.createDataFrame(rows, "query_id bigint, query_intent int, corpus_id bigint, corpus_intent int, similarity double")
    got = {}
    for r in rt.intent_rerank(top).collect():
        got.setdefault((r.query_id, r.fallback), {})[r.example_no] = r.corpus_id
    assert got == {(1, False): {1: 2, 2: 5, 3: 9}, (2, True): {1: 0, 2: 1, 3: 2}, (3, True): {1: 0, 2: 1}}


def test_retrieve_examples_gives_three_per_query(data):
    _, _, qf, cf = data
    counts = rt.retrieve_examples(qf, cf, "id", "id", "intent", "intent").groupBy("query_id").count().collect()
    assert len(counts) == 37 and {r["count"] for r in counts} == {3}


def test_vectors_to_compute(spark):
    todo = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, t string")
    cache = spark.createDataFrame([(1, "a", "m1"), (2, "old", "m1"), (3, "c", "m0")], "id bigint, t string, model_version string").select(
        "id", "model_version", F.xxhash64("t").alias("text_hash"))
    assert sorted(r.id for r in rt.vectors_to_compute(todo, cache, "id", "t", "m1").collect()) == [2, 3]


def test_normalize_dot_and_encoder(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0], "ab"), (2, [0.0, 0.0], "abc")], "id int, v array<double>, t string")
    rows = df.select(rt.normalize(F.col("v")).alias("u"), rt.dot(F.col("v"), F.col("v")).alias("d")).collect()
    assert [r.u for r in rows] == [[0.6, 0.8], [0.0, 0.0]] and [r.d for r in rows] == [25.0, 0.0]
    coded = rt.encode_column(df, "t", lambda texts: [[len(t), 0.0] for t in texts]).collect()
    assert [r.embedding for r in coded] == [[1.0, 0.0], [1.0, 0.0]]


def test_build_corpus(spark):
    pairs = spark.createDataFrame([(1, False, "x" * 50), (2, True, "x" * 50), (3, False, "x")], "id bigint, has_link boolean, brand_reply_clean string")
    vectors = spark.createDataFrame([(i, [1.0]) for i in (1, 2, 3)], "id bigint, embedding array<float>")
    assert [r.id for r in rt.build_corpus(pairs, vectors, "id").collect()] == [1]
