import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from spark_triage.operators import features as ft
from spark_triage.operators import kmeans as km
from spark_triage.operators import models as md
from spark_triage.plans import discover

STOP = ["the", "a"]
DOCS = [
    (1, "late parcel late again", "delivery", 0), (2, "the parcel is lost", "delivery", 0), (3, "refund my money now", "refund", 1),
    (4, "money back refund refund", "refund", 1), (5, "parcel refund", "refund", 1), (6, "a parcel!", "delivery", 0),
]


def docs(spark):
    return spark.createDataFrame(DOCS, "id bigint, text string, intent string, cluster int")


def brute_tfidf(groups, max_terms):
    import re

    tf = {g: Counter(w for t in texts for w in re.findall(r"\w\w+", t.lower()) if w not in STOP) for g, texts in groups.items()}
    total = Counter()
    for c in tf.values():
        total.update(c)
    vocab = sorted(total, key=lambda w: (-total[w], w))[:max_terms]
    n, out = len(groups), {}
    for g, c in tf.items():
        w = {t: c[t] * (math.log((1 + n) / (1 + sum(t in d for d in tf.values()))) + 1) for t in vocab if c[t]}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(g, t): x / norm for t, x in w.items()})
    return out


@pytest.mark.parametrize("max_terms", [3, 5000])
def test_tfidf_per_text_and_per_cluster(spark, max_terms):
    by_doc = {i: [t] for i, t, *_ in DOCS}
    got = {(r.id, r.term): r.weight for r in ft.tfidf(docs(spark), "id", "text", STOP, max_terms).collect()}
    assert got == pytest.approx(brute_tfidf(by_doc, max_terms))
    by_cluster = {c: [t for _, t, _, x in DOCS if x == c] for c in (0, 1)}
    want = brute_tfidf(by_cluster, max_terms)
    rows = ft.cluster_terms(docs(spark), "cluster", "text", STOP, 2, max_terms).collect()
    for c in (0, 1):
        order = sorted((k for k in want if k[0] == c), key=lambda k: (-round(want[k], 9), k[1]))[:2]
        assert [(r.cluster, r.term) for r in sorted(rows, key=lambda r: r["rank"]) if r.cluster == c] == order


def test_pipeline_features_agree_with_the_relational_ones(spark):
    model = md.train_classifier(docs(spark), "text", "intent", stop_words=STOP, max_iter=20)
    vocabulary = model.stages[2].vocabulary
    got = {}
    for r in PipelineModel(model.stages[:5]).transform(docs(spark)).collect():
        for i, w in zip(r["_features"].indices if hasattr(r["_features"], "indices") else range(len(r["_features"])), r["_features"].toArray()[r["_features"].toArray() != 0]):
            got[r.id, vocabulary[i]] = w
    want = {(r.id, r.term): r.weight for r in ft.tfidf(docs(spark), "id", "text", STOP).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("balanced", [False, True])
def test_classifier_learns_and_reloads(spark, tmp_path, balanced):
    model = md.train_classifier(docs(spark), "text", "intent", balanced, stop_words=STOP)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    scored = md.classify(docs(spark), PipelineModel.load(path))
    assert scored.columns == ["id", "text", "intent", "cluster", "predicted_intent"]
    assert all(r.intent == r.predicted_intent for r in scored.collect())


def test_regression_is_the_c_equal_one_optimum(spark):
    """The gradient of sum(loss) + ||w||^2 / 2 vanishes at the fit."""
    model = md.train_classifier(docs(spark), "text", "intent", stop_words=STOP)
    lr = model.stages[5]
    rows = PipelineModel(model.stages[:6]).transform(docs(spark)).collect()
    x = np.array([r["_features"].toArray() for r in rows])
    y = np.array([r.intent == "refund" for r in rows]).astype(int)
    w = lr.coefficientMatrix.toArray()
    p = np.array([r.probability.toArray() for r in rows])
    assert np.abs((p - np.eye(2)[y]).T @ x + w).max() < 5e-3


def test_class_weights(spark):
    got = {r.intent: (r.n, r.weight) for r in md.class_weights(docs(spark).filter("id < 6"), "intent").collect()}
    assert got == {"delivery": (2, 5 / 4), "refund": (3, pytest.approx(5 / 6))}


def brute_silhouette(x, labels):
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][labels == o].mean() for o in set(labels) if o != c)
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("block", [7, 2048])
def test_silhouette(spark, block):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(0, 0.2, (20, 4)), rng.normal(1, 0.2, (15, 4)), [[9.0] * 4]]
    labels = np.array([0] * 18 + [1] * 17 + [2])
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, labels))], "id bigint, embedding array<double>, cluster int")
    got = {r.id: r.silhouette for r in md.silhouette(df, "id", "cluster", block_rows=block).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(brute_silhouette(x, labels), abs=1e-9)


def test_a_pair_of_blocks_needs_little_memory():
    x = np.random.default_rng(4).normal(size=(8192, 16))
    labels = np.arange(len(x)) % 3
    side = lambda i, c, v: pa.table({i: np.arange(len(x)), c: list(labels[:, None]), v: list(x)})
    left, right = side("id", "labels", "vec"), side("other_id", "other_labels", "other_vec")
    tracemalloc.start()
    got = md._distance_sums(left, right).to_pylist()[:3]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.linalg.norm(x - x[0], axis=1)
    assert peak < 96 << 20 and [r["total"] for r in got] == pytest.approx([want[labels == c].sum() for c in range(3)])


def blobs(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(60):
        v = rng.normal(0, 0.05, 3) + np.eye(3)[i % 3]
        rows.append((i, [float(a) for a in v / np.linalg.norm(v)], f"topic{i % 3} word{i % 3} common"))
    return spark.createDataFrame(rows, "id bigint, embedding array<double>, text string")


def test_discovery_finds_the_blobs(spark):
    out = discover.discover(blobs(spark), "id", "text", 3, sample=60, ks=(2, 3, 4), stop_words=STOP, starts=3)
    scan = {r.k: r.silhouette for r in out["scan"].collect()}
    assert max(scan, key=scan.get) == 3
    clusters = {}
    for r in out["labelled"].collect():
        clusters.setdefault(r.cluster, set()).add(r.id % 3)
    assert sorted(len(s) for s in clusters.values()) == [1, 1, 1]
    lines = out["report"].orderBy("cluster", "line_no").collect()
    assert [r.line_no for r in lines if r.cluster == 0] == list(range(11))
    assert lines[0].line == "## Cluster 0 (n=20)" and lines[1].line.startswith("**Top TF-IDF terms:** ")
    assert sum(r.line.startswith("- ") for r in lines) == 24


def test_all_fits_step_together(spark):
    sc, df = spark.sparkContext, blobs(spark)
    sc.setJobGroup("fits", "")
    fits = km.fit_many(df, "id", (2, 3, 4), starts=5)
    jobs = len(sc.statusTracker().getJobIdsForGroup("fits"))
    sc.setJobGroup("", "")
    assert len(fits) == 15 and jobs <= 10 + 2 * max(f.steps for f in fits)
    x = np.array([r.embedding for r in df.orderBy("id").collect()])
    for f in fits:
        own = km.distances(x, f.centers).argmin(1)
        assert f.settled and f.n.tolist() == np.bincount(own, minlength=f.k).tolist()
        assert f.cost == pytest.approx(((x - f.centers[own]) ** 2).sum())
        assert all(np.allclose(f.centers[c], x[own == c].mean(0), atol=1e-4) for c in range(f.k))
    best = km.best_of(fits)
    assert [f.k for f in best] == [2, 3, 4] and all(b.cost <= f.cost for b in best for f in fits if f.k == b.k)


def test_fits_with_few_different_points_and_none(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(10)] + [(99, None)], "id long, embedding array<double>")
    fit, = km.fit_many(df, "id", (5,), starts=1)
    assert len(fit.centers) == 2 and fit.cost == 0 and sorted(fit.n) == [5, 5]
    assert km.fit_many(df.limit(0), "id", (2,)) == []
    labels = {r.id: r.labels for r in km.label_many(df, [fit]).collect()}
    assert labels[99] is None and labels[0] != labels[1] and labels[0] == labels[2]
    with pytest.warns(UserWarning, match="did not settle"):
        km.fit_many(blobs(spark), "id", (4,), starts=2, max_iter=1)


def brute_linear(x, labels):
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        others = [d[i][labels == o].mean() for o in set(labels) if o != c]
        if own.sum() == 1 or not others:
            out.append(0.0)
            continue
        a, b = d[i][own].sum() / (own.sum() - 1), min(others)
        out.append((b - a) / max(a, b))
    return out


def test_silhouette_linear(spark):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(0, 0.2, (20, 4)), rng.normal(1, 0.2, (15, 4)), [[9.0] * 4]]
    labels = np.array([0] * 18 + [4] * 17 + [7])
    schema = "id bigint, embedding array<double>, cluster int"
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, labels))]
    df = spark.createDataFrame([*rows, (90, None, 4), (91, [0.0] * 4, None)], schema).repartition(5)
    got = {r.id: r.silhouette for r in km.silhouette_linear(df, "id", "cluster").collect()}
    assert len(got) == len(x) and [got[i] for i in range(len(x))] == pytest.approx(brute_linear(x, labels), abs=1e-9)
    one = km.silhouette_linear(df.filter("cluster = 0"), "id", "cluster").collect()
    assert {r.silhouette for r in one} == {0.0}


def test_both_scans_find_the_blobs(spark):
    for exact in (True, False):
        scan = {r.k: r.silhouette for r in km.scan_k(blobs(spark), "id", (2, 3, 4), starts=3, exact=exact).collect()}
        assert max(scan, key=scan.get) == 3
        fits = km.best_of(km.fit_many(blobs(spark), "id", (2, 3, 4), starts=3))
        x = np.array([r.embedding for r in blobs(spark).orderBy("id").collect()])
        want = {f.k: np.mean((brute_silhouette if exact else brute_linear)(x, km.distances(x, f.centers).argmin(1))) for f in fits}
        assert scan == pytest.approx(want, abs=1e-9)


def test_default_stop_words(spark):
    words = ft.default_stop_words()
    assert "the" in words and words[-1] == "url"
    assert ft.english_stop_words() == words[:-1]


def test_the_classifier_keeps_the_word_of_the_placeholder(spark):
    rows = [(f"url case {i}", "a") for i in range(6)] + [(f"plain thing {i}", "b") for i in range(6)]
    model = md.train_classifier(spark.createDataFrame(rows, "t string, y string"), "t", "y")
    assert "url" in next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))


def test_unsettled_starts_are_reported(spark):
    with pytest.warns(UserWarning, match="did not settle"):
        md.best_kmeans(blobs(spark), 3, starts=2, max_iter=1)


def test_cluster_examples_are_seeded(spark):
    a = discover.cluster_examples(blobs(spark).withColumn("c", F.col("id") % 2), "c", "id", "text", 4)
    b = discover.cluster_examples(blobs(spark).repartition(3).withColumn("c", F.col("id") % 2), "c", "id", "text", 4)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == 8


def test_all_starts_share_their_steps(spark, monkeypatch):
    passes, step = [], km.step
    monkeypatch.setattr(km, "step", lambda blocks, fits: (passes.append(list(fits)), step(blocks, fits))[1])
    model = md.best_kmeans(blobs(spark), 3, starts=4)
    fits = passes[0]
    assert len(fits) == 4 and len(passes) == max(f.steps for f in fits)
    x = np.array([r.embedding for r in blobs(spark).collect()])
    for f in fits:
        assert f.cost == pytest.approx(km.distances(x, f.centers).min(1).sum(), abs=1e-6)
    centers = np.array(model.clusterCenters())
    assert km.distances(x, centers).min(1).sum() <= min(f.cost for f in fits) + 1e-6
    got = {r.id: r.cluster for r in md.assign_clusters(blobs(spark), model).collect()}
    assert got == {r.id: km.distances(np.array([r.embedding]), centers).argmin() for r in blobs(spark).collect()}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_packed_points_come_back(spark, kind):
    x = np.random.default_rng(5).normal(size=(9000, 3)).astype(np.float32 if kind == "float" else np.float64)
    blocks = km.packed(spark.createDataFrame([(v.tolist(),) for v in x], f"vec array<{kind}>").coalesce(1))
    got = np.concatenate([p for b in blocks.toArrow().to_batches() for p in km._unpacked(b)])
    assert sorted(map(tuple, got)) == sorted(map(tuple, x.astype(np.float64)))
    with pytest.raises(Exception, match="different lengths"):
        km.packed(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], f"vec array<{kind}>").coalesce(1)).count()


def test_a_model_keeps_the_order_of_its_centers(spark):
    for n in (1, 3, 9):
        centers = np.random.default_rng(n).normal(size=(n, 2))
        assert np.array_equal(md._model_of(spark, centers).clusterCenters(), centers)
    assert np.array_equal(md._model_of(spark, np.array([[1.0], [0.0], [1.0]])).clusterCenters(), [[1.0], [0.0]])


@pytest.mark.parametrize("balanced", [False, True])
def test_training_reads_its_texts_once(spark, balanced):
    read = spark.sparkContext.accumulator(0)

    def counted(text):
        read.add(1)
        return text

    rows = docs(spark).withColumn("text", F.udf(counted)("text"))
    model = md.train_classifier(rows, "text", "intent", balanced, stop_words=STOP)
    assert read.value == len(DOCS)
    plain = md.train_classifier(docs(spark), "text", "intent", balanced, stop_words=STOP)
    found, want = (dict(zip(m.stages[2].vocabulary, m.stages[5].coefficientMatrix.toArray()[0])) for m in (model, plain))
    assert found == pytest.approx(want, abs=1e-3)
