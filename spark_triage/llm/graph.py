"""Connected components by alternating large-star and small-star steps, all joins and grouped minima."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) with a > b. Large: neighbours above a node move to the lowest node it sees.
    Small: the neighbours below a node, and the node, move to the lowest of them."""
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    seen = down.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else down
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = seen.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


HELD_EDGES = 1 << 19  # that a task joins up at a time


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of some rows as stars: every node of a connected part, and the part's lowest node; the lowest node is
    there with itself. Parts are joined up among ``HELD_EDGES`` edges at a time."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def stars() -> pa.RecordBatch:
        nodes = list(up)
        out = pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["a", "b"])
        up.clear()
        return out

    n = 0
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
        n += batch.num_rows
        if n >= HELD_EDGES:
            n = 0
            yield stars()
    if up:
        yield stars()


def _all_stars(edges: DataFrame) -> bool:
    """Whether no node stands above two others, or both above one and below another."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("above"), F.lit(0).alias("below")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("above"), F.lit(1).alias("below")))
    counts = ends.groupBy("x").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return counts.filter((F.col("above") + F.col("below") > 1) & (F.col("above") > 0)).limit(1).count() == 0


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is its lowest node.

    A task first makes stars of the edges that it has. Each round is written to the shared folder, so a lost executor
    repeats one round, and rounds end when all that is left are stars, each a component. The number of rounds grows with
    the logarithm of the longest chain. Loops and repeated edges do no harm; an empty table gives no rows.
    """
    once = staged(edges.select("a", "b").mapInArrow(contracted, "a bigint, b bigint").distinct(), name)
    cur = once.filter("a <> b")
    while not _all_stars(cur):
        cur = staged(_star(_star(cur, True), False), name)
    stars = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # every node that is no ray of a star is a centre, or stands alone
    nodes = once.select(F.col("b").alias("node")).distinct().join(stars.select("node"), "node", "left_anti")
    return stars.unionByName(nodes.select("node", F.col("node").alias("component")))
