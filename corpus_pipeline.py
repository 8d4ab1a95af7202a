"""The corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept; ``run`` writes each result
to the shared folder and reads it back as the next stage's documents. All stages but the last return the columns of
documents as they came, and any further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_triage.llm import neardup, packing, pii, quality, substring
from spark_triage.llm.common import broadcast_checked, load, staged
from spark_triage.llm.queries import vocabulary

#: The column that tells rows apart inside a stage.
KEY = "__pipeline_row"
#: Keys of copies (8 bytes each) that go to every task; where there are more, rows and copies meet by a shuffle.
COPIES_SENT = 4_000_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the rules, with a host that passes too, each by its own verdict, whatever its id."""
    return quality.passing_rows(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one of lowest id; of rows that share that id one stays, and a row
    without an id stays only if none of its group has one. Rows are told apart by a key, not by their ids; it is written
    once, so that a row keeps its key however often it is read."""
    keyed = docs.withColumn(KEY, F.monotonically_increasing_id())
    rows = staged(keyed, "pipeline-rows", compression="zstd")
    groups = neardup.near_duplicates(rows, id_col=KEY).select(F.col("doc_id").alias(KEY), "component_id")
    groups = staged(groups.join(rows.select(KEY, "doc_id"), KEY), "pipeline-groups")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", KEY)
    first = groups.groupBy("component_id").agg(F.min(order).alias("first")).select(f"first.{KEY}")
    out = groups.select(KEY).join(first, KEY, "left_anti")
    copies = broadcast_checked(staged(out, "pipeline-copies"), COPIES_SENT)
    return rows.join(copies, KEY, "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the words of repeated passages taken out; one of which nothing is left goes. A document without
    repeated words keeps its text as it was, white space included."""
    rest = [c for c in docs.columns if c != "text"]
    rows = substring.without_repeats(docs, keep=tuple(rest), as_is=True).filter("n_removed = 0 or kept_text <> ''")
    size = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars"))
    return rows.select(*[_column(docs, c, F.col("kept_text"), size) for c in docs.columns])


def _column(docs: DataFrame, name: str, text: Column, n_chars: Column) -> Column:
    """A column of the rows that hold ``docs`` columns in ``row``, with a new text and length."""
    if name == "text":
        return text.alias(name)
    if name == "n_chars":
        return n_chars.cast(docs.schema[name].dataType).alias(name)
    return F.col("row")[name].alias(name)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    rows = pii.find(docs, keep=tuple(docs.columns))
    found = F.size("all_spans") > 0
    clean = F.when(found, pii.redacted(F.col("row.text"), F.col("all_spans"))).otherwise(F.col("row.text"))
    size = F.when(found, F.length(clean)).otherwise(F.col("row.n_chars"))
    return rows.select(*[_column(docs, c, clean, size) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Tokens of a vocabulary file, fitted trees and shingle components have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
