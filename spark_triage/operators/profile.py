"""Counts, rates and distributions over pairs and scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import text as tx


def share(flag: Column) -> Column:
    return F.avg(flag.cast("double"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def length_profile(df: DataFrame, text_col: str, by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """describe() of text lengths. Lengths are counted first, so the quartile step sees one row per
    distinct length and not one per text."""
    counts = df.groupBy(*by, F.length(text_col).cast("bigint").alias("len")).agg(F.count("*").alias("n"))
    counts = counts.filter(F.col("len").isNotNull())
    total, s1 = F.sum("n"), F.sum(F.col("n") * F.col("len"))
    s2 = F.sum((F.col("n") * F.col("len") * F.col("len")).cast("decimal(38,0)")).cast("double")
    spread = F.sqrt((s2 - s1 * s1.cast("double") / total) / F.nullif(total - 1, F.lit(0)))
    q = F.percentile("len", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    return counts.groupBy(*by).agg(
        total.alias("n"), F.bround(s1 / total, digits).alias("mean"), F.bround(spread, digits).alias("std"),
        F.min("len").alias("min"), F.bround(q[0], digits).alias("q1"), F.bround(q[1], digits).alias("median"),
        F.bround(q[2], digits).alias("q3"), F.max("len").alias("max"),
    )


def deflection_rate(pairs: DataFrame, patterns: Sequence[str] = fv.DEFLECTION_PATTERNS) -> DataFrame:
    flag = tx.deflection_flag(F.col("brand_reply"), patterns)
    return pairs.agg(
        F.count("*").alias("n"), F.count_if(flag).alias("n_deflected"), share(flag).alias("rate")
    )


def flag_examples(pairs: DataFrame, flag: Column, text_col: str, id_col: str) -> DataFrame:
    """One row per flag value: the text with the lowest id."""
    return pairs.groupBy(flag.alias("flag")).agg(
        F.min(id_col).alias(id_col), F.min_by(text_col, id_col).alias(text_col)
    )


def pii_affected(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose unescaped text changes under redaction, per column."""

    def changed(c: str) -> Column:
        plain = tx.unescape_html(F.col(c))
        return F.count_if(tx.redact_pii(plain) != plain)

    return df.agg(*[changed(c).alias(f"{c}_rows") for c in columns])


def pii_residue(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where an address or phone pattern is still found, per column."""
    return df.agg(
        *[F.count_if(F.rlike(c, F.lit(f"{tx.EMAIL}|{tx.PHONE}"))).alias(f"{c}_rows") for c in columns]
    )


def language_outcomes(detected: DataFrame, language: str = "en") -> DataFrame:
    lang = F.col("detected")
    return detected.agg(
        F.count_if(lang.isNull()).alias("n_errored"),
        F.count_if(lang != language).alias("n_other"),
        F.count_if(lang == language).alias("n_kept"),
    )


def dedupe_counts(
    kept: DataFrame, text_col: str = "customer_tweet_clean", reply_col: str = "brand_reply_clean",
    id_col: str = "brand_reply_id", cap: int = fv.REPLY_TEMPLATE_CAP,
) -> DataFrame:
    """(n_deduped, n_templates, n_capped) in one pass over the de-duplicated rows."""
    firsts = kept.groupBy(text_col).agg(F.min_by(reply_col, id_col).alias(reply_col))
    per_template = firsts.groupBy(reply_col).agg(F.count("*").alias("n"))
    return per_template.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_deduped"),
        F.count(reply_col).alias("n_templates"),
        F.coalesce(F.sum(F.least("n", F.lit(cap))), F.lit(0)).alias("n_capped"),
    )


def funnel(steps: DataFrame) -> DataFrame:
    """(step_no, step, rows_kept) to rows in, removed and kept. One row per step, so the frame is tiny."""
    w = Window.orderBy("step_no")
    return steps.withColumn("rows_in", F.coalesce(F.lag("rows_kept").over(w), F.col("rows_kept"))).select(
        "step_no", "step", "rows_in", (F.col("rows_in") - F.col("rows_kept")).alias("rows_removed"), "rows_kept"
    )


def sample_sanity(full: DataFrame, sample: DataFrame, text_col: str = "brand_reply_clean") -> DataFrame:
    """Reply length and link rate of a sample beside its population."""
    both = union_all(
        [d.select(F.lit(name).alias("set"), text_col, "has_link") for name, d in (("full", full), ("working", sample))]
    )
    counts = both.groupBy("set", F.length(text_col).cast("bigint").alias("len")).agg(
        F.count("*").alias("n"), F.count_if("has_link").alias("links")
    )
    return counts.groupBy("set").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("len")) / F.sum(F.when(F.col("len").isNotNull(), F.col("n")))).alias("mean_len"),
        F.percentile("len", F.lit(0.5), F.col("n")).alias("median_len"),
        (F.sum("links") / F.sum("n")).alias("link_rate"),
    )


def brand_volume(messages: DataFrame, top: int) -> DataFrame:
    """Reply authors by number of messages."""
    return (
        messages.filter(~F.col("inbound")).groupBy("author_id").agg(F.count("*").alias("n_replies"))
        .orderBy(F.col("n_replies").desc(), "author_id").limit(top)
    )


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int = 100_000) -> DataFrame:
    """Exact linear-interpolated quantiles of a numeric column, as (prob, value)."""
    return exact_quantiles_of(df, [col], probs, accuracy).select("prob", "value")


def exact_quantiles_of(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 100_000) -> DataFrame:
    """Exact linear-interpolated quantiles of numeric columns, as (column, prob, value).

    The rows are read three times, however many columns and probabilities there are, so give a table or a staged frame.
    One pass sketches every column, which brackets each wanted rank within ten times the sketch's error bound; one counts
    what lies below each bracket; one takes the values inside the (column, rank) brackets, collapsed to one row per
    value, in order. A rank outside its bracket raises instead of giving a wrong value. NULLs take no part; a column
    without a value gives no rows.
    """
    rows = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    every = [(i, j) for i in range(len(columns)) for j in range(len(probs))]
    margin = 10.0 / accuracy
    ends = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    stats = rows.agg(F.array(*[
        F.struct(
            F.percentile_approx(f"v{i}", F.array(*[F.lit(e) for e in ends]), F.lit(accuracy)).alias("edges"),
            F.min(f"v{i}").alias("min"), F.max(f"v{i}").alias("max"), F.count(f"v{i}").alias("n"))
        for i in range(len(columns))]).alias("x")).scalar()

    def bracket(i: int, j: int) -> tuple[Column, Column]:
        own = stats[i]
        few = own["n"] * margin < 2  # the margin is no full rank then, and the whole range is the bracket
        return (F.when(few, own["min"]).otherwise(F.element_at(own["edges"], 2 * j + 1)),
                F.when(few, own["max"]).otherwise(F.element_at(own["edges"], 2 * j + 2)))

    below = rows.agg(F.array(*[F.count_if(F.col(f"v{i}") < bracket(i, j)[0]) for i, j in every]).alias("x")).scalar()
    inside = F.array_compact(F.array(*[
        F.when(F.col(f"v{i}").between(*bracket(i, j)), F.struct(F.lit(slot + 1).alias("slot"), F.col(f"v{i}").alias("v")))
        for slot, (i, j) in enumerate(every)]))
    counts = (
        rows.select(F.explode(inside).alias("b")).groupBy("b.slot", "b.v").agg(F.count("*").alias("n"))
        .withColumn("below", F.element_at(below, F.col("slot")))
    )
    upto = F.col("below") + F.sum("n").over(Window.partitionBy("slot").orderBy("v"))
    wanted = lambda values: F.element_at(F.array(*[F.lit(x) for x in values]), F.col("slot"))
    total = F.element_at(F.array(*[stats[i]["n"] for i in range(len(columns))]), wanted([i + 1 for i, _ in every]))
    ranked = counts.withColumn("upto", upto).withColumn("prob", wanted([float(probs[j]) for _, j in every])).withColumn(
        "pos", F.col("prob") * (total - 1))

    def value_at(rank: Column) -> Column:
        hit = (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto"))
        return F.max(F.when(hit, F.col("v")))

    found = ranked.groupBy("slot", "prob", "pos").agg(
        value_at(F.floor("pos")).alias("low"), value_at(F.ceil("pos")).alias("high")
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("pos") - F.floor("pos"))
    return found.select(
        wanted([columns[i] for i, _ in every]).alias("column"), "prob",
        F.coalesce(value, F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")).alias("value")
    )


def score_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min / quartiles / max per score column, long form, all columns from the same passes."""
    points = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    name = F.element_at(F.create_map(*[F.lit(x) for kv in points.items() for x in kv]), F.col("prob"))
    return exact_quantiles_of(df, columns, list(points)).select(F.col("column").alias("score"), name.alias("point"), "value")


def derive_thresholds(df: DataFrame, confidence: str, similarity: str, prob: float = 0.25, digits: int = 2) -> DataFrame:
    """The lower quartile of each score, rounded, as (policy field, value)."""
    field = F.when(F.col("column") == confidence, "min_confidence").otherwise("min_similarity")
    return exact_quantiles_of(df, [confidence, similarity], [prob]).select(
        field.alias("threshold"), F.round("value", digits).alias("value"))
