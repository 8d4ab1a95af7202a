"""Finding intents: a seeded sample, clusters of it, and what each cluster talks about."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.operators import features as ft
from spark_triage.operators import kmeans as km
from spark_triage.operators import models as md
from spark_triage.operators import profile as pf
from spark_triage.operators import sampling as sm
from spark_triage.session import staged


def cluster_examples(
    df: DataFrame, cluster: str, id_col: str, text_col: str, n: int = fv.EXAMPLES_PER_CLUSTER,
    seed: int = fv.DISCOVERY_SEED,
) -> DataFrame:
    order = [sm.hash_key(id_col, seed), F.col(id_col)]
    return sm.top_per_group(df, cluster, order, n, id_col, "example_no").select(cluster, "example_no", id_col, text_col)


def cluster_report(labelled: DataFrame, cluster: str, id_col: str, text_col: str, stop_words: Sequence[str]) -> DataFrame:
    """(cluster, line_no, line): size, heaviest terms and examples of each cluster, ready to write."""
    sizes = labelled.groupBy(cluster).agg(F.count("*").alias("n"))
    terms = ft.cluster_terms(labelled, cluster, text_col, stop_words).groupBy(cluster).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]), ", ").alias("terms")
    )
    head = sizes.join(terms, cluster, "left").select(
        cluster, F.posexplode(F.array(
            F.format_string("## Cluster %d (n=%d)", F.col(cluster), F.col("n")),
            F.concat(F.lit("**Top TF-IDF terms:** "), F.coalesce("terms", F.lit(""))),
            F.lit("**Example tweets:**"),
        )).alias("line_no", "line"),
    )
    shown = cluster_examples(labelled, cluster, id_col, text_col).select(
        cluster, (F.col("example_no") + 2).alias("line_no"), F.concat(F.lit("- "), F.col(text_col)).alias("line")
    )
    return pf.union_all([head, shown])


def discover(
    rows: DataFrame, id_col: str, text_col: str, k: int, vector: str = "embedding",
    sample: int = fv.DISCOVERY_SAMPLE, seed: int = fv.DISCOVERY_SEED, ks: Sequence[int] = fv.K_CANDIDATES,
    stop_words: Sequence[str] | None = None, starts: int = fv.KMEANS_STARTS,
) -> dict[str, DataFrame]:
    """``rows`` carry their vectors. Gives the silhouette per candidate k, the labels for ``k`` and a report."""
    drawn = staged(sm.seeded_sample(rows.filter(F.col(vector).isNotNull()), id_col, seed, sample), "discovery")
    labelled = md.assign_clusters(drawn, md.best_kmeans(drawn, k, vector, starts), vector)
    words = ft.default_stop_words() if stop_words is None else stop_words
    return {
        "scan": km.scan_k(drawn, id_col, ks, vector, starts, seed),
        "labelled": labelled,
        "report": cluster_report(labelled, "cluster", id_col, text_col, words),
    }
