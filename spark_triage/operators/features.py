"""Term weights as plain joins and aggregates: TF-IDF per text or per cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions.text import WORD
from spark_triage.session import broadcast_up_to, staged

TERM = rf"[{WORD}]{{2,}}"


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("english"))


def default_stop_words() -> list[str]:
    """The words left out of a cluster's terms: English ones, and what the URL placeholder leaves behind."""
    return [*english_stop_words(), "url"]


def found_terms(text_col: str) -> Column:
    """The terms of a text in turn; NULL without a text."""
    return F.regexp_extract_all(F.lower(text_col), F.lit(TERM), F.lit(0))


def _exploded(df: DataFrame, group: str, found: Column, stop_words: Sequence[str]) -> DataFrame:
    terms = df.select(group, F.explode(found).alias("term"))
    # The join on terms needs this filter; stated here, both uses of the counts share one shuffle.
    return terms.filter(F.col("term").isNotNull() & ~F.col("term").isin(*stop_words))


def term_counts(
    df: DataFrame, group: str, text_col: str, stop_words: Sequence[str], marked: bool = False
) -> DataFrame:
    """(group, term, tf). Counted in the task that reads the text before anything moves. ``marked`` adds the empty term
    once for every row, so that groups without terms are counted in the same pass."""
    found = found_terms(text_col)
    if marked:
        found = F.array_append(F.coalesce(found, F.array().cast("array<string>")), F.lit(""))
    return _exploded(df, group, found, stop_words).groupBy(group, "term").agg(F.count("*").alias("tf"))


def shared_ids(df: DataFrame, id_col: str) -> DataFrame:
    """The ids that more than one row has, written once."""
    return staged(df.groupBy(id_col).agg(F.count("*").alias("_rows")).filter(
        (F.col("_rows") > 1) & F.col(id_col).isNotNull()).select(id_col), "shared-ids")


def document_counts(df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str]) -> DataFrame:
    """(term, df): the number of ids whose text holds the term.

    A row whose id no other row has is a text of its own: its distinct terms are counted by term at once, so one row per
    term leaves a task. Only rows that share an id, or have none, are first counted by id and term.
    """
    shared = shared_ids(df, id_col)
    own = df.filter(F.col(id_col).isNotNull()).join(shared, id_col, "left_anti")
    rest = df.join(shared, id_col, "left_semi").unionByName(df.filter(F.col(id_col).isNull()))
    single = _exploded(own, id_col, F.array_distinct(found_terms(text_col)), stop_words)
    counts = [x.groupBy("term").agg(F.count("*").alias("df")) for x in (single, term_counts(rest, id_col, text_col, stop_words))]
    return counts[0].unionByName(counts[1]).groupBy("term").agg(F.sum("df").alias("df"))


def tfidf(
    df: DataFrame, group: str, text_col: str, stop_words: Sequence[str], max_terms: int = fv.MAX_TERMS
) -> DataFrame:
    """(group, term, tf, weight): tf * (ln((1 + n) / (1 + df)) + 1), L2-normalised per group, over the
    ``max_terms`` most frequent terms. A group stands for one document, so all texts of a cluster count
    as one without being joined into a string."""
    every = staged(term_counts(df, group, text_col, stop_words, marked=True), "term-counts")  # the texts are read once
    counts = every.filter(F.col("term") != "")
    vocabulary = (
        counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
        .orderBy(F.col("total").desc(), "term").limit(max_terms).select("term", "df")
    )
    n_groups = every.filter(F.col("term") == "").agg(F.count(group).alias("n")).scalar()
    idf = F.ln((F.lit(1.0) + F.col("n_groups")) / (F.lit(1.0) + F.col("df"))) + 1
    weighted = counts.join(broadcast_up_to(vocabulary, max_terms), "term").withColumn("n_groups", n_groups).withColumn("w", F.col("tf") * idf)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(group)))
    return weighted.select(group, "term", "tf", (F.col("w") / norm).alias("weight"))


def cluster_terms(
    df: DataFrame, cluster: str, text_col: str, stop_words: Sequence[str], top: int = fv.TERMS_PER_CLUSTER,
    max_terms: int = fv.MAX_TERMS,
) -> DataFrame:
    """The ``top`` heaviest terms of each cluster with their rank."""
    # Weights that differ only by summation order must not swap places: rank at 9 decimals, then by term.
    w = Window.partitionBy(cluster).orderBy(F.round("weight", 9).desc(), "term")
    return (
        tfidf(df, cluster, text_col, stop_words, max_terms)
        .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    )
