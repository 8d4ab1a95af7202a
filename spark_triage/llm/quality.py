"""Quality rules on documents and on their hosts.

Every document is measured and judged by itself. The failures of each rule are then counted by host, and each host's
rate is shrunk towards the rate of all hosts by a beta prior whose strength comes from how much the hosts differ. A
host whose shrunk rate of some rule passes the limit is rejected with all its documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spark_triage.llm import wordhash as wh
from spark_triage.llm.common import CACHES, broadcast_checked, lean_worker, map_batches, staged

#: Fixed value: characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
HOST_LIMIT = 0.5
_U = np.uint64


def rules() -> dict[str, Column]:
    """The rules that judge a document: name -> whether it fails."""
    return {
        "few_words": F.col("n_words") < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
    }


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[inverse] > 1


def _own(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return wh.mix(hashes ^ ((doc.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15)))


def measure_piece(p: wh.Piece, width: int) -> dict[str, np.ndarray]:
    ends = np.append(p.begin, p.end[-1:])
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[ends])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    n, texts = len(p.hashes), len(p.rows)
    doc = np.repeat(np.arange(texts), np.diff(p.words))
    covered = np.zeros(n, bool)
    grams = wh.windows(p.hashes, width)
    at = np.flatnonzero(doc[: n - width + 1] == doc[width - 1 :]) if n >= width else np.zeros(0, np.int64)
    if len(at):
        at = at[_repeats(_own(grams[at], doc[at]))]
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + width, -1)
        covered = np.cumsum(step[:-1]) > 0
    breaks = np.flatnonzero(p.data == 10)
    start, stop = np.concatenate([p.begin, breaks + 1]), np.concatenate([p.end, breaks])
    start, stop = np.sort(start), np.sort(stop)
    line_doc = np.searchsorted(p.end, stop, "left")  # the first text that reaches this far; empty ones are dropped below
    solid = np.concatenate([[0], np.cumsum(~p.space, dtype=np.int64)])
    some = solid[stop] > solid[start]
    start, stop, line_doc = start[some], stop[some], line_doc[some]
    dup = np.zeros(texts, np.int64)
    if len(start):
        keys = _own(p.stretch_hash(start, stop), line_doc)
        order = np.argsort(keys, kind="stable")
        again = keys[order][1:] == keys[order][:-1]
        dup = np.bincount(line_doc[order][1:][again], minlength=texts)
    covered = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
    return {
        "n_words": np.diff(p.words), "word_chars": per_text(~p.space & ((p.data & 0xC0) != 0x80)),
        "n_symbols": per_text(symbol[p.data]), "n_dup_lines": dup, "n_repeat_words": np.diff(covered[p.words]),
    }


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str, width: int = 5,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, row) of whole texts."""

    def run(batch):
        parts = [measure_piece(p, width) for p in wh.pieces(batch.column("text"))]
        out = {"doc_id": batch.column("doc_id"), "host": batch.column("host")} | {
            m: np.concatenate([x[m] for x in parts]).astype(np.int64) for m in MEASURES}
        return out | ({"row": batch.column("row")} if keep else {})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).cast("string").alias("text"), *[F.struct(*keep).alias("row")][: len(keep)])
    schema = StructType.fromDDL("doc_id bigint, host string, " + ", ".join(f"{m} bigint" for m in MEASURES))
    if keep:
        schema = schema.add(rows.schema["row"])
    return map_batches(rows, run, schema)


def prior(hosts: DataFrame, fails: str, default_strength: float = 10.0) -> tuple[float, float]:
    """(alpha, beta) fitted to the hosts' counts: the mean is the rate of all documents, the strength comes from the
    variance between hosts beyond what chance gives. Without such variance the hosts count as one."""
    s = hosts.agg(
        F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum(fails).alias("k"),
        F.sum(F.col(fails) * F.col(fails) / F.col("n")).alias("kk"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    if not s["n"]:
        return default_strength / 2, default_strength / 2
    mean = s["k"] / s["n"]
    noise = mean * (1 - mean)
    free = s["n"] - s["nn"] / s["n"] - (s["hosts"] - 1)
    strength = default_strength
    if noise > 0 and free > 0:
        share = (s["kk"] - s["n"] * mean * mean - noise * (s["hosts"] - 1)) / (noise * free)
        strength = 1 / min(max(share, 1e-6), 0.999) - 1
    return mean * strength, (1 - mean) * strength


def host_verdicts(judged: DataFrame, names: list[str], limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n, <rule>_rate.., host_rejected) of ``judged`` (host, <rule>: boolean); rows without a host are left out."""
    counts = staged(judged.filter("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in names]), "quality-hosts")
    out = counts
    for r in names:
        alpha, beta = prior(counts, r)
        out = out.withColumn(f"{r}_rate", F.round((F.col(r) + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta)), 9))
    over = F.greatest(*[F.col(f"{r}_rate") for r in names], F.lit(0.0)) > F.lit(limit)
    return out.select("host", "n", *[f"{r}_rate" for r in names], over.alias("host_rejected"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            limit: float = HOST_LIMIT, judge: dict[str, Column] | None = None,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host_rejected), one
    row per row of ``docs``, and ``row``, a struct of the columns ``keep``, if there are any.

    ``judge``: rule name -> column over the measures, by default ``rules()``. ``base_failed``: a rule fails;
    ``kept``: none does and the host is not rejected. Null and empty texts measure 0. A document without a host is
    judged by itself. Rows that share an id are judged apart.
    """
    judge = judge or rules()
    names = list(judge)
    judged = staged(
        measures(docs, id_col, text_col, host_col, keep=keep).select("*", *[c.alias(r) for r, c in judge.items()]), "quality-measures")
    rejected = staged(host_verdicts(judged, [*names], limit).filter("host_rejected").select("host", "host_rejected"),
                      "quality-rejected")
    failed = F.lit(False)
    for r in names:
        failed = failed | F.col(r)
    return judged.join(rejected, "host", "left").select(
        "doc_id", *MEASURES, failed.alias("base_failed"),
        (~failed & F.col("host_rejected").isNull()).alias("kept"),
        F.coalesce("host_rejected", F.lit(False)).alias("host_rejected"), *["row"][: len(keep)])


HOSTS_SENT = 200_000  # rejected hosts that go to every task; more are joined by a shuffle


def passing_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 limit: float = HOST_LIMIT, judge: dict[str, Column] | None = None) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, each by its own verdict, with their columns.

    The texts are measured twice: once for the counts of the hosts, and again where a row is kept or dropped, so no text
    is written or shuffled.
    """
    judge = judge or rules()
    names = list(judge)
    judged = measures(docs, id_col, text_col, host_col).select("host", *[c.alias(r) for r, c in judge.items()])
    rejected = staged(host_verdicts(judged, names, limit).filter("host_rejected").select("host"), "quality-rejected")
    failed = F.lit(False)
    for c in judge.values():
        failed = failed | c
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(host_col).cast("string").alias("host"),
                       _measured()(F.col(text_col).cast("string")).alias("m"))
    kept = rows.select("row", "host", "m.*").filter(~failed)
    return kept.join(broadcast_checked(rejected, HOSTS_SENT), "host", "left_anti").select("row.*")


def _measured(width: int = 5):
    """The measures of a text column; only the texts go to Python, the rows stay where they are."""

    @F.arrow_udf(", ".join(f"{m} bigint" for m in MEASURES))
    def run(column: pa.Array) -> pa.Array:
        if any(name.startswith(CACHES) for name in wh.worker_state()):
            lean_worker()
        parts = [measure_piece(p, width) for p in wh.pieces(column)]
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([x[m] for x in parts]).astype(np.int64)) for m in MEASURES], list(MEASURES))

    return run
