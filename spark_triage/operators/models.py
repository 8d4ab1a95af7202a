"""Clustering and the text classifier, on Spark ML."""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import (
    IDF, CountVectorizer, ElementwiseProduct, IndexToString, Normalizer, RegexTokenizer, StopWordsRemover,
    StringIndexer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.operators import kmeans as km
from spark_triage.operators.features import TERM, english_stop_words
from spark_triage.session import staged


_PARALLEL_FITS = 4
_CELLS = 1 << 21  # distances that a task holds at once
_DISTANCE_SUMS = "id bigint, place int, own int, cluster int, total double, n bigint"
_SUMS_SCHEMA = pa.schema([("id", pa.int64()), ("place", pa.int32()), ("own", pa.int32()), ("cluster", pa.int32()),
                          ("total", pa.float64()), ("n", pa.int64())])


def best_kmeans(
    df: DataFrame, k: int, vector: str = "embedding", starts: int = fv.KMEANS_STARTS, seed: int = fv.DISCOVERY_SEED,
    max_iter: int = fv.KMEANS_MAX_ITER,
) -> KMeansModel:
    """The start with the lowest cost of ``starts`` seeded ones. A start that ``max_iter`` ends before it has settled
    is reported as a warning.

    Spark draws the first centers of every start (k-means||, from all points); then all starts step together, one pass
    over the points a step for all of them. The model's summary is that of its centers, not of the points.
    """
    points = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")).persist()
    try:
        points.count()  # fill the cache once, before the starts run side by side
        drawn = inheritable_thread_target(df.sparkSession)(
            lambda i: np.array(KMeans(k=k, seed=seed + i, maxIter=0).fit(points).clusterCenters())
        )
        with ThreadPool(min(starts, _PARALLEL_FITS)) as pool:
            fits = [km.Fit(k, i, centers) for i, centers in enumerate(pool.map(drawn, range(starts)))]
    finally:
        points.unpersist()
    km.settle(km.packed(df.select(F.col(vector).alias("vec"))), fits, max_iter, 1e-4)
    best = min(fits, key=lambda f: f.cost)
    return _model_of(df.sparkSession, km.moved(best))


def _model_of(spark: SparkSession, centers: np.ndarray) -> KMeansModel:
    """Spark's model with these ``centers`` in this order: a fit of no steps to the centers themselves. It takes all of
    them, shuffled by its seed; the second fit gets them in the order that the first one's shuffle undoes. Of equal
    centers, of which only the first would get points, one is kept."""
    centers = centers[np.sort(np.unique(centers, axis=0, return_index=True)[1])]
    frame = lambda rows: spark.createDataFrame([(Vectors.dense(c),) for c in rows], ["features"]).coalesce(1)
    fit = lambda rows: KMeans(k=max(2, len(centers)), seed=0, initMode="random", maxIter=0).fit(frame(rows))
    order = [int(np.abs(centers - c).sum(1).argmin()) for c in fit(centers).clusterCenters()]
    model = fit(centers[np.argsort(order)])
    if not np.array_equal(np.array(model.clusterCenters()), centers):
        raise ValueError("the centers did not come back as they were given")
    return model


def assign_clusters(df: DataFrame, model: KMeansModel, vector: str = "embedding", out: str = "cluster") -> DataFrame:
    with_features = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    return model.setFeaturesCol("features").setPredictionCol(out).transform(with_features).drop("features")


def _rows_of(column: pa.ChunkedArray) -> np.ndarray:
    """A column of lists of one length as a matrix; NULL elements are NaN."""
    if column.null_count:
        raise ValueError("a row without a vector or labels has no silhouette")
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distance_sums(x: pa.Table, y: pa.Table) -> pa.Table:
    """Of a pair of blocks, for each row of ``x`` the sum of its distances to each cluster of ``y``."""
    if not x.num_rows or not y.num_rows:
        return _SUMS_SCHEMA.empty_table()
    p, q, mine, theirs = (_rows_of(t[c]) for t, c in ((x, "vec"), (y, "other_vec"), (x, "labels"), (y, "other_labels")))
    p, q = p.astype(np.float64), q.astype(np.float64)
    places, names, members = [], [], []
    for i in range(theirs.shape[1]):
        found, at = np.unique(theirs[:, i], return_inverse=True)
        places.append(np.full(len(found), i))
        names.append(found)
        members.append(np.eye(len(found))[at])
    place, name, member = np.concatenate(places), np.concatenate(names), np.concatenate(members, 1)
    ids, others = x["id"].to_numpy(), y["other_id"].to_numpy()
    total, n, m = np.empty((len(p), len(name))), member.sum(0), len(name)
    length = (q * q).sum(1)[None, :]
    step = max(1, _CELLS // len(q))
    for at in range(0, len(p), step):  # a slice of the distance matrix at a time
        s = slice(at, at + step)
        dist = p[s] @ q.T
        dist *= -2
        dist += (p[s] * p[s]).sum(1)[:, None]
        dist += length
        np.sqrt(np.maximum(dist, 0, out=dist), out=dist)
        dist[ids[s][:, None] == others[None, :]] = 0.0
        total[s] = dist @ member
    columns = (np.repeat(ids, m), np.tile(place, len(p)), mine[:, place].ravel(), np.tile(name, len(p)), total.ravel(),
               np.tile(n, len(p)))
    return pa.Table.from_arrays(
        [pa.array(c, f.type, from_pandas=True) for c, f in zip(columns, _SUMS_SCHEMA)], schema=_SUMS_SCHEMA)


def silhouettes(
    df: DataFrame, id_col: str, labels: str, vector: str = "embedding", block_rows: int = 16_384
) -> DataFrame:
    """(id, place, cluster, silhouette) with exact Euclidean distances, for every place of the array ``labels``.

    Rows are cut into hashed blocks and every pair of blocks meets in one task, which takes each distance once for all
    labellings and gives one distance sum per row, place and cluster, never one row per pair. A row alone in its cluster
    scores 0.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(labels).cast("array<int>").alias("labels"), F.col(vector).alias("vec"))
    blocks = max(1, math.ceil(rows.count() / block_rows))
    home = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = home.withColumnRenamed("block", "a").withColumn("b", every)
    # The same rows meet themselves, so the second copy gets columns of its own.
    right = home.select(
        F.col("id").alias("other_id"), F.col("labels").alias("other_labels"), F.col("vec").alias("other_vec"),
        F.col("block").alias("y"), every.alias("x"),
    )

    sums = (
        left.groupBy("a", "b").cogroup(right.groupBy("x", "y"))
        .applyInArrow(_distance_sums, _DISTANCE_SUMS)
        .groupBy("id", "place", "own", "cluster").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    inside = F.col("cluster") == F.col("own")
    per_row = sums.groupBy("id", "place", "own").agg(
        F.max(F.when(inside, F.col("total") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~inside, F.col("total") / F.col("n"))).alias("b"),
    )
    score = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return per_row.select(F.col("id").alias(id_col), "place", F.col("own").alias("cluster"), score.alias("silhouette"))


def silhouette(
    df: DataFrame, id_col: str, cluster: str, vector: str = "embedding", block_rows: int = 16_384
) -> DataFrame:
    """(id, cluster, silhouette) with exact Euclidean distances, the one labelling ``cluster``."""
    rows = df.select(id_col, F.array(F.col(cluster).cast("int")).alias("_labels"), vector)
    return silhouettes(rows, id_col, "_labels", vector, block_rows).select(id_col, F.col("cluster").alias(cluster), "silhouette")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): n_rows / (n_classes * n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes")).alias("x")).scalar()
    return counts.withColumn("t", totals).select(
        label, "n", (F.col("t.rows") / (F.col("t.classes") * F.col("n"))).alias("weight")
    )


def train_classifier(
    df: DataFrame, text_col: str, label: str, balanced: bool = False, max_terms: int = fv.MAX_TERMS,
    stop_words: Sequence[str] | None = None, max_iter: int = 1000,
) -> PipelineModel:
    """TF-IDF and multinomial logistic regression (L2, C = 1), optionally with balanced class weights.

    The result is a saved-and-loaded-as-one PipelineModel giving ``predicted_intent`` and ``probability``. Texts are read
    and cut into terms once; the terms and then their counts are written for the passes that need them.
    """
    rows = df.select(F.col(text_col), F.col(label))
    if balanced:
        rows = rows.join(class_weights(df, label).select(label, "weight"), label)
    tokens = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TERM, gaps=False)
    kept = StopWordsRemover(
        inputCol="_tokens", outputCol="_terms",
        stopWords=list(english_stop_words() if stop_words is None else stop_words),
    )
    counts = CountVectorizer(inputCol="_terms", outputCol="_tf", vocabSize=max_terms)
    extra = ["weight"] if balanced else []
    terms = staged(kept.transform(tokens.transform(rows)).select("_terms", label, *extra), "classifier-terms")
    front = [tokens, kept, counts.fit(terms)]
    counted = staged(front[-1].transform(terms).select("_tf", label, *extra), "classifier-counts")
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf  # at most max_terms numbers
    scale = ElementwiseProduct(inputCol="_tf", outputCol="_scaled", scalingVec=Vectors.dense(idf.toArray() + 1.0))
    unit = Normalizer(inputCol="_scaled", outputCol="_features", p=2.0)
    index = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(counted)
    ready = index.transform(unit.transform(scale.transform(counted))).select(
        "_features", "_label", *extra
    )
    ready = ready.persist()  # every solver step reads them; how many partitions there are is the caller's choice
    n = ready.count()
    lr = LogisticRegression(
        featuresCol="_features", labelCol="_label", predictionCol="_prediction", probabilityCol="probability",
        rawPredictionCol="_raw", family="multinomial", regParam=1.0 / n, elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-6, **({"weightCol": "weight"} if balanced else {}),
    )
    try:
        lr = lr.fit(ready)
    finally:
        ready.unpersist()
    name = IndexToString(inputCol="_prediction", outputCol="predicted_intent", labels=index.labels)
    return PipelineModel([*front, scale, unit, lr, name])


def gradients(
    df: DataFrame, model: PipelineModel, text_col: str, label: str, balanced: bool = False
) -> DataFrame:
    """(label, n, gradient, gradient_at_zero): the gradient of the objective that ``train_classifier`` minimises, at the
    fitted model and at the model of nothing but zeros, as the length of its part for each label, intercept included. At
    the optimum the first is near 0, and how near is said by the second.

    A task sums residual times features over its rows, one row per label; these are added up as they stream by.
    """
    rows = df.select(text_col, F.col(label).alias("_true"), F.lit(1.0).alias("_one"))
    if balanced:
        weights = class_weights(df, label).select(F.col(label).alias("_true"), F.col("weight").alias("_one"))
        rows = rows.drop("_one").join(weights, "_true")
    lr = next(s for s in model.stages if hasattr(s, "coefficientMatrix"))
    names = next(s for s in model.stages if isinstance(s, IndexToString)).getLabels()
    scored = model.transform(rows).select(
        F.col("_true").alias("label"), "_one", vector_to_array("_features").alias("x"), vector_to_array("probability").alias("p"))
    held = df.sparkSession.sparkContext.broadcast((names, lr.coefficientMatrix.toArray()))  # set by labels and terms
    regularized = lr.getRegParam()
    kind = "label string, n bigint, rows double, now array<double>, start array<double>"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = held.value
        k, size = len(names), weights.shape[1] + 1
        n, total, now, start = np.zeros(k, np.int64), 0.0, np.zeros((k, size)), np.zeros((k, size))
        for batch in batches:
            for some in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                x, p = (some.column(c).flatten().to_numpy().reshape(some.num_rows, -1) for c in ("x", "p"))
                x = np.concatenate([x, np.ones((len(x), 1))], 1)  # the intercept comes last
                w = some.column("_one").to_numpy()
                own = np.array([names.index(v) for v in some.column("label").to_pylist()])
                is_own = np.eye(k)[own]
                n += is_own.sum(0).astype(np.int64)
                total += float(w.sum())
                now += ((p - is_own) * w[:, None]).T @ x
                start += ((1 / k - is_own) * w[:, None]).T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(n), pa.array([total] * k), pa.array(list(now), pa.list_(pa.float64())),
             pa.array(list(start), pa.list_(pa.float64()))], ["label", "n", "rows", "now", "start"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = held.value
        out: dict[str, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                new = [r["n"], r["rows"], np.array(r["now"]), np.array(r["start"])]
                out[r["label"]] = [a + b for a, b in zip(out[r["label"]], new)] if r["label"] in out else new
        for name, (n, total, now, start) in out.items():
            pull = np.append(regularized * weights[names.index(name)], 0.0)
            yield pa.RecordBatch.from_pydict({
                "label": [name], "n": [n], "gradient": [float(np.linalg.norm(now / total + pull))],
                "gradient_at_zero": [float(np.linalg.norm(start / total))]})

    return scored.mapInArrow(part, kind).repartition("label").mapInArrow(
        add_up, "label string, n bigint, gradient double, gradient_at_zero double")


def classify(df: DataFrame, model: PipelineModel, out: str = "predicted_intent") -> DataFrame:
    """Rows with the model's label; also how corpus intents are backfilled."""
    scored = model.transform(df)
    return scored.select(*[c for c in df.columns if c != out], F.col("predicted_intent").alias(out))
