"""k-means for many numbers of clusters and many starts at once, and silhouettes of its labels.

All fits step together: a step is one pass over the points, in which every batch is compared with the centers of all
fits by one matrix product, its rows are dealt to clusters, and the assignment matrix gives the sums of every cluster by
another product. A task gives one row per fit, however many points it has, and these rows are added up as they stream by. Points
are read in every step, so they are written once as blocks of bytes, which a task takes in as they are.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.session import staged

INIT_ROWS = 4096
BLOCK_ROWS = 4096  # points in a block
MAX_CLUSTERS = 10_000
_SUMS = "fit int, n array<double>, sums array<double>, squares array<double>, cost double"


@dataclass
class Fit:
    """Centers of one start, and how its points lie: per cluster their number, sum and sum of squared lengths."""

    k: int
    start: int
    centers: np.ndarray
    n: np.ndarray | None = None
    sums: np.ndarray | None = None
    squares: np.ndarray | None = None
    cost: float = float("inf")
    steps: int = 0
    settled: bool = False


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def spread_centers(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of ``points``, each drawn in proportion to its squared distance from those before; fewer if there are not
    so many different ones."""
    centers = [points[rng.integers(len(points))]]
    near = ((points - centers[0]) ** 2).sum(1)
    while len(centers) < k and near.max() > 0:
        centers.append(points[rng.choice(len(points), p=near / near.sum())])
        near = np.minimum(near, ((points - centers[-1]) ** 2).sum(1))
    return np.array(centers)


def distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances."""
    return (points * points).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2 * (points @ centers.T)


def packed(points: DataFrame) -> DataFrame:
    """The vectors of ``points`` (vec) in blocks (n, vectors), an element in as many bytes as its type has; written."""
    kind = np.float32 if points.schema["vec"].dataType.elementType.typeName() == "float" else np.float64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            if len(column) and pc.count_distinct(pc.list_value_length(column)).as_py() > 1:
                raise ValueError("vectors of different lengths")
            x = _matrix(column).astype(kind) if len(column) else np.zeros((0, 1), kind)
            parts = [x[at : at + BLOCK_ROWS] for at in range(0, len(x), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(p) for p in parts], pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["n", "vectors"])

    typed = points.select(F.col("vec").cast("array<float>" if kind is np.float32 else "array<double>"))
    return staged(typed.mapInArrow(pack, "n int, vectors binary"), "kmeans-blocks").withColumn("width", F.lit(kind().itemsize))


def _unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for n, vectors, width in zip(*(batch.column(c) for c in ("n", "vectors", "width"))):
        flat = np.frombuffer(vectors.as_buffer(), np.float32 if width.as_py() == 4 else np.float64)
        yield flat.reshape(n.as_py(), -1).astype(np.float64)


def step(blocks: DataFrame, fits: Sequence[Fit]) -> None:
    """One pass over ``packed`` points: every fit gets the numbers, sums and cost of its clusters."""
    held = blocks.sparkSession.sparkContext.broadcast([f.centers for f in fits])  # parameters set its size

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = held.value
        every = np.concatenate(centers)
        ends = np.cumsum([0, *map(len, centers)])
        n, squares, cost = np.zeros(len(every)), np.zeros(len(every)), np.zeros(len(centers))
        sums = np.zeros(every.shape)
        for x in (x for batch in batches for x in _unpacked(batch)):
            far = distances(x, every)
            member = np.zeros(far.shape)
            rows = np.arange(len(x))
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                own = a + far[:, a:b].argmin(1)
                member[rows, own] = 1.0
                cost[i] += np.maximum(far[rows, own], 0).sum()
            n += member.sum(0)
            sums += member.T @ x
            squares += member.T @ (x * x).sum(1)
        yield _rows(enumerate((n[a:b], sums[a:b], squares[a:b], cost[i]) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                new = [np.array(r[c]) for c in ("n", "sums", "squares", "cost")]
                out[r["fit"]] = [a + b for a, b in zip(out[r["fit"]], new)] if r["fit"] in out else new
        if out:
            yield _rows(out.items())

    for r in blocks.mapInArrow(total, _SUMS).repartition("fit").mapInArrow(add_up, _SUMS).collect():  # one row per fit
        f = fits[r["fit"]]
        f.n, f.squares, f.cost = np.array(r["n"]), np.array(r["squares"]), r["cost"]
        f.sums = np.array(r["sums"]).reshape(len(f.n), -1)


def _rows(items) -> pa.RecordBatch:
    fit, parts = zip(*items)
    n, sums, squares, cost = zip(*parts)
    doubles = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(fit, pa.int32()), pa.array(n, doubles), pa.array([np.ravel(x) for x in sums], doubles),
         pa.array(squares, doubles), pa.array([float(c) for c in cost], pa.float64())],
        ["fit", "n", "sums", "squares", "cost"])


def moved(fit: Fit) -> np.ndarray:
    """The means of the points that were nearest to each center; a cluster that lost all its points keeps its center."""
    return np.where(fit.n[:, None] > 0, fit.sums / np.maximum(fit.n, 1)[:, None], fit.centers)


def settle(blocks: DataFrame, fits: Sequence[Fit], max_iter: int, tol: float) -> None:
    """Steps of all ``fits`` together, until no center of a fit moves by more than ``tol`` or for ``max_iter`` steps. A
    settled fit keeps the centers that its points were dealt to; fits that did not settle are reported as a warning."""
    for _ in range(max_iter):
        moving = [f for f in fits if not f.settled]
        if not moving:
            break
        step(blocks, moving)
        for f in moving:
            f.steps += 1
            new = moved(f)
            f.settled = bool((((new - f.centers) ** 2).sum(1) <= tol * tol).all())
            if not f.settled:
                f.centers = new
    open_ended = sum(not f.settled for f in fits)
    if open_ended:
        warnings.warn(f"{open_ended} of {len(fits)} k-means starts did not settle in {max_iter} steps", stacklevel=3)


def fit_many(
    df: DataFrame, id_col: str, ks: Sequence[int] = fv.K_CANDIDATES, vector: str = "embedding",
    starts: int = fv.KMEANS_STARTS, seed: int = fv.DISCOVERY_SEED, max_iter: int = fv.KMEANS_MAX_ITER,
    tol: float = 1e-4, init_rows: int = INIT_ROWS,
) -> list[Fit]:
    """``starts`` fits for each k, all stepping together over all points.

    First centers are spread over a seeded sample of ``init_rows`` points. A fit has settled when no center moves by more
    than ``tol``; one that ``max_iter`` ends before is reported as a warning. Rows without a vector take no part. A
    cluster that loses all its points keeps its center.
    """
    from spark_triage.operators.sampling import seeded_sample

    rows = df.filter(F.col(vector).isNotNull()).select(F.col(id_col), F.col(vector).alias("vec"))
    rows = staged(rows, "kmeans-points")
    drawn = np.array([r["vec"] for r in seeded_sample(rows, id_col, seed, init_rows).repartition(1).sortWithinPartitions(id_col).collect()])
    if not len(drawn):
        return []
    fits = [Fit(k, s, spread_centers(drawn, k, np.random.default_rng((seed, k, s)))) for k in ks for s in range(starts)]
    settle(packed(rows.select("vec")), fits, max_iter, tol)
    return fits


def best_of(fits: Sequence[Fit]) -> list[Fit]:
    """For each k the start of least cost."""
    return [min((f for f in fits if f.k == k), key=lambda f: f.cost) for k in dict.fromkeys(f.k for f in fits)]


def label_many(df: DataFrame, fits: Sequence[Fit], vector: str = "embedding", out: str = "labels") -> DataFrame:
    """``df`` with ``out``: the nearest cluster of each fit, in order of ``fits``; NULL without a vector."""
    held = df.sparkSession.sparkContext.broadcast([f.centers for f in fits])

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        known = vectors[vectors.notna()]
        if not len(known):
            return pd.Series([None] * len(vectors), index=vectors.index)
        x = np.stack([np.asarray(v, np.float64) for v in known])
        found = np.stack([distances(x, c).argmin(1) for c in held.value], 1).astype(np.int32)
        return pd.Series(list(found), index=known.index).reindex(vectors.index).replace({np.nan: None})

    return df.withColumn(out, nearest(F.col(vector)))


def label_means(df: DataFrame, fits: Sequence[Fit], vector: str = "embedding", slack: float = 1e-3) -> DataFrame:
    """(k, n_rows, n_elsewhere) of each fit: rows, and rows that are nearer to the mean of another cluster than to that of
    their own by more than ``slack``, a settled fit's centers being within its tolerance of the means."""
    means = df.sparkSession.sparkContext.broadcast([(f.k, f.centers, f.sums / np.maximum(f.n, 1)[:, None]) for f in fits])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, elsewhere = 0, np.zeros(len(means.value), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            n += len(x)
            for i, (_, centers, mean) in enumerate(means.value):
                far = np.sqrt(np.maximum(distances(x, mean), 0))
                own = far[np.arange(len(x)), distances(x, centers).argmin(1)]
                elsewhere[i] += int((own > far.min(1) + slack).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, *_ in means.value], pa.int32()), pa.array([n] * len(elsewhere), pa.int64()), pa.array(elsewhere)],
            ["k", "n_rows", "n_elsewhere"])

    points = df.filter(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("vec"))
    return points.mapInArrow(count, "k int, n_rows bigint, n_elsewhere bigint").groupBy("k").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_elsewhere").alias("n_elsewhere"))


def linear_parts(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Silhouettes of ``x`` in the clusters ``own`` by squared Euclidean distance, from what is known of each cluster."""
    total = (x * x).sum(1)[:, None] * n + squares - 2 * (x @ sums.T)  # of squared distances to a cluster's points
    rows = np.arange(len(x))
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.maximum(total[rows, own], 0) / (n[own] - 1)
        other = np.maximum(total, 0) / n
        other[:, n == 0] = np.inf
        other[rows, own] = np.inf
        b = other.min(1)
        score = (b - a) / np.maximum(a, b)
    return np.where((n[own] > 1) & np.isfinite(b), np.nan_to_num(score), 0.0)


def silhouette_linear(df: DataFrame, id_col: str, cluster: str, vector: str = "embedding") -> DataFrame:
    """(id, cluster, silhouette) by squared Euclidean distance, in two passes whatever the number of rows.

    The mean squared distance of a row to a cluster follows from the cluster's number of rows, the sum of its vectors and
    the sum of their squared lengths: one row per cluster, of which at most ``MAX_CLUSTERS`` are taken. It is not the
    silhouette of plain distances (``models.silhouette``), but ranks clusterings much alike. A row alone in its cluster,
    or whose cluster is the only one, scores 0; rows without a vector or cluster are left out.
    """
    rows = df.filter(F.col(vector).isNotNull() & F.col(cluster).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(cluster).cast("int").alias("cluster"), F.col(vector).cast("array<double>").alias("vec"))
    kind = "cluster int, n bigint, sums array<double>, squares double"

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, list] = {}
        for batch in batches:
            x, own = _matrix(batch.column("vec")), batch.column("cluster").to_numpy()
            labels, place = np.unique(own, return_inverse=True)
            member = np.eye(len(labels))[place]
            for c, n, s, q in zip(labels.tolist(), member.sum(0), member.T @ x, member.T @ (x * x).sum(1)):
                old = out.get(c, [0, 0.0, 0.0])
                out[c] = [old[0] + int(n), old[1] + s, old[2] + float(q)]
        yield from _stats(out)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                old = out.get(r["cluster"], [0, 0.0, 0.0])
                out[r["cluster"]] = [old[0] + r["n"], old[1] + np.array(r["sums"]), old[2] + r["squares"]]
        yield from _stats(out)

    def _stats(out: dict[int, list]) -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int32()), pa.array([v[0] for v in out.values()], pa.int64()),
                 pa.array([v[1] for v in out.values()], pa.list_(pa.float64())),
                 pa.array([v[2] for v in out.values()], pa.float64())], ["cluster", "n", "sums", "squares"])

    stats = rows.mapInArrow(total, kind).repartition("cluster").mapInArrow(add_up, kind).limit(MAX_CLUSTERS + 1).collect()
    if len(stats) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    stats.sort(key=lambda r: r["cluster"])
    names = np.array([r["cluster"] for r in stats], np.int32)
    held = df.sparkSession.sparkContext.broadcast(
        (np.array([r["n"] for r in stats], np.float64), np.array([r["sums"] for r in stats]), np.array([r["squares"] for r in stats])))

    @F.pandas_udf("double")
    def score(vectors: pd.Series, clusters: pd.Series) -> pd.Series:
        x = np.stack([np.asarray(v, np.float64) for v in vectors])
        return pd.Series(linear_parts(*held.value, x, np.searchsorted(names, clusters.to_numpy())))

    return rows.select(F.col("id").alias(id_col), F.col("cluster").alias(cluster), score("vec", "cluster").alias("silhouette"))


def scan_k(
    df: DataFrame, id_col: str, ks: Sequence[int] = fv.K_CANDIDATES, vector: str = "embedding",
    starts: int = fv.KMEANS_STARTS, seed: int = fv.DISCOVERY_SEED, exact: bool = True, fits: Sequence[Fit] | None = None,
) -> DataFrame:
    """(k, n_clusters, cost, silhouette) for every candidate k, all fits from the same passes over the points; ``fits``
    are given if they were made before.

    ``exact`` silhouettes take plain distances of all pairs of rows, each pair once for all k; the others follow from
    the sums of the clusters, by squared distance.
    """
    from spark_triage.operators.models import silhouettes

    fits = best_of(fit_many(df, id_col, ks, vector, starts, seed) if fits is None else fits)
    spark = df.sparkSession
    known = spark.createDataFrame([(i, f.k, int((f.n > 0).sum()), float(f.cost)) for i, f in enumerate(fits)],
                                  "place int, k int, n_clusters int, cost double")
    rows = df.filter(F.col(vector).isNotNull())
    if exact:
        scores = silhouettes(label_many(rows, fits, vector), id_col, "labels", vector).groupBy("place").agg(
            F.avg("silhouette").alias("silhouette"))
    else:
        held = spark.sparkContext.broadcast([(f.centers, f.n, f.sums, f.squares) for f in fits])

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score, n = np.zeros(len(held.value)), 0
            for batch in batches:
                x = _matrix(batch.column(0))
                n += len(x)
                score += [linear_parts(*sums, x, distances(x, centers).argmin(1)).sum() for centers, *sums in held.value]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(score)), pa.int32()), pa.array(score), pa.array([n] * len(score), pa.int64())], ["place", "s", "n"])

        parts = rows.select(F.col(vector).cast("array<double>")).mapInArrow(total, "place int, s double, n bigint")
        scores = parts.groupBy("place").agg((F.sum("s") / F.sum("n")).alias("silhouette"))
    return known.join(scores, "place").select("k", "n_clusters", "cost", "silhouette")
