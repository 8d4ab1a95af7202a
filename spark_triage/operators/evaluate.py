"""Confusion matrices, per-class metrics, method comparison, agreement and result tables.

Everything starts from counted cells, so the rows are read once and only label pairs move.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def label_distribution(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def majority_label(df: DataFrame, label: str) -> DataFrame:
    return label_distribution(df, label).orderBy(F.col("n").desc(), label).limit(1)


def confusion_matrix(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(true_label, pred_label, n) over the union of labels, zero cells included."""
    cells = df.groupBy(F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(F.count("*").alias("n"))
    both = cells.select(F.explode(F.array("true_label", "pred_label")).alias("label")).distinct()
    labels = both.agg(F.array_sort(F.collect_set("label")).alias("x")).scalar()
    grid = both.filter("label IS NOT NULL").select(F.col("label").alias("true_label"), F.explode(labels).alias("pred_label"))
    return grid.join(cells, ["true_label", "pred_label"], "left").na.fill(0, ["n"])


def confusion_wide(df: DataFrame, true: str, pred: str, labels: Sequence[str]) -> DataFrame:
    """One row per true label, one column per predicted label."""
    return (
        df.groupBy(F.col(true).alias("true_label")).pivot(pred, list(labels)).agg(F.count(F.lit(1))).na.fill(0)
    )


def accuracy(df: DataFrame, true: str, pred: str) -> DataFrame:
    hit = F.coalesce(F.col(true) == F.col(pred), F.lit(False)).cast("double")
    return df.agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def classification_report(df: DataFrame, true: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """precision / recall / F1 / support per label, 0 where undefined; labels seen on either side."""
    t, p = F.col(true).cast("string"), F.col(pred).cast("string")
    cells = df.groupBy(*by, t.alias("t"), p.alias("p")).agg(F.count("*").alias("n"))
    roles = F.array(
        F.struct(F.col("t").alias("label"), F.lit(1).alias("is_true"), (F.col("t") == F.col("p")).cast("int").alias("hit")),
        F.struct(F.col("p").alias("label"), F.lit(0).alias("is_true"), F.lit(0).alias("hit")),
    )
    tp = F.coalesce(F.sum(F.col("n") * F.col("r.hit")), F.lit(0))
    support = F.sum(F.col("n") * F.col("r.is_true"))
    predicted = F.sum(F.col("n") * (1 - F.col("r.is_true")))
    return (
        cells.select(*by, "n", F.explode(roles).alias("r")).groupBy(*by, F.col("r.label").alias("label"))
        .agg(
            ratio(tp, predicted).alias("precision"), ratio(tp, support).alias("recall"),
            ratio(2 * tp, support + predicted).alias("f1"), support.alias("support"), tp.alias("hits"),
        )
    )


METRICS = (
    "intent_accuracy", "intent_macro_f1", "escalation_precision", "escalation_recall", "escalation_f1",
    "escalation_accuracy",
)


def compare_methods(rows: DataFrame, by: Sequence[str] = ("method",)) -> DataFrame:
    """Six metrics per method from long rows (method, true_intent, pred_intent, true_decision, pred_decision)."""
    tasks = F.array(
        F.struct(F.lit("intent").alias("task"), F.col("true_intent").alias("t"), F.col("pred_intent").alias("p")),
        F.struct(F.lit("escalation").alias("task"), F.col("true_decision").alias("t"), F.col("pred_decision").alias("p")),
    )
    report = classification_report(
        rows.select(*by, F.explode(tasks).alias("x")).select(*by, "x.*"), "t", "p", [*by, "task"]
    )
    intent, esc = F.col("task") == "intent", F.col("task") == "escalation"
    pick = lambda c: F.coalesce(F.max(F.when(esc & (F.col("label") == "escalate"), F.col(c))), F.lit(0.0))
    acc = lambda cond: ratio(F.sum(F.when(cond, F.col("hits"))), F.sum(F.when(cond, F.col("support"))))
    return report.groupBy(*by).agg(
        acc(intent).alias("intent_accuracy"), F.avg(F.when(intent, F.col("f1"))).alias("intent_macro_f1"),
        pick("precision").alias("escalation_precision"), pick("recall").alias("escalation_recall"),
        pick("f1").alias("escalation_f1"), acc(esc).alias("escalation_accuracy"),
    )


def method_rows(golden: DataFrame, pseudo: DataFrame, simple_intent: str, high_risk=fv.HIGH_RISK_INTENTS) -> DataFrame:
    """Golden rows once per method: trivial (majority label, always escalate), simple (cheap label, high-risk
    rule), full (the system's own output)."""
    from spark_triage.functions.policy import decide_by_intent

    majority = majority_label(pseudo, "predicted_intent").select(F.col("predicted_intent").alias("x")).scalar()
    based = golden.withColumn("_majority", majority)

    def method(name: str, intent: Column, decision: Column) -> Column:
        return F.struct(F.lit(name).alias("method"), intent.alias("pred_intent"), decision.alias("pred_decision"))

    methods = F.array(
        method("Trivial baseline", F.col("_majority"), F.lit("escalate")),
        method("Simple baseline", F.col(simple_intent), decide_by_intent(F.col(simple_intent), high_risk)),
        method("Full system", F.col("predicted_intent"), F.col("escalation_decision")),
    )
    return based.select(
        "customer_tweet_id", "hard_case_category", "true_intent",
        F.col("true_escalation_decision").alias("true_decision"), F.explode(methods).alias("m"),
    ).select("customer_tweet_id", "hard_case_category", "true_intent", "true_decision", "m.*")


def table_line(cells: Sequence[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def comparison_lines(compared: DataFrame) -> DataFrame:
    """(method, line): one Markdown table row per method, metrics at three places."""
    return compared.select(
        "method", table_line([F.col("method"), *[F.format_string("%.3f", F.col(m)) for m in METRICS]]).alias("line")
    )


_FRACTION_STEPS = 60


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, a fixed number of steps of it."""
    first = 1 / (1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def turn(acc: Column, k: Column) -> Column:
        d = 1 / (1 + k * acc["d"])
        c = 1 + k / acc["c"]
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * c * d).alias("h"))

    def step(acc: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return turn(turn(acc, even), odd)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_FRACTION_STEPS)), start, step, lambda acc: acc["h"])


def two_sided_p(rho: Column, n: Column) -> Column:
    """p-value of a rank correlation under the t distribution with n - 2 degrees of freedom, for any n.

    It is the regularised incomplete beta function of 1 - rho^2 at (n - 2) / 2 and 1 / 2, small values directly and
    without cancellation. NULL for a missing rho or fewer than 3 rows.
    """
    df = n - 2
    a, half = df / 2, F.lit(0.5)
    r2 = F.least(rho * rho, F.lit(1.0))
    # gamma(a + 1/2) / gamma(a): its series at a + 20, carried back
    z = a + 20
    series = (1 - 1 / (8 * z) + 1 / (128 * z**2) + 5 / (1024 * z**3) - 21 / (32768 * z**4) - 399 / (262144 * z**5)
              + 869 / (4194304 * z**6))
    back = F.aggregate(F.sequence(F.lit(0), F.lit(19)), F.lit(1.0), lambda acc, j: acc * (a + j) / (a + j + 0.5))
    front = F.exp(a * F.log1p(-r2)) * F.sqrt(r2) * F.sqrt(z) * series * back / math.sqrt(math.pi)
    return (
        F.when(rho.isNull() | (df < 1), F.lit(None).cast("double"))
        .when(r2 >= 1, F.lit(0.0))
        .when(1 - r2 < (a + 1) / (a + 2.5), front * _beta_fraction(a, half, 1 - r2) / a)
        .otherwise(1 - front * _beta_fraction(half, a, r2) / 0.5)
    )


def score_pairs(human: DataFrame, judge: DataFrame, id_col: str, dimensions: Sequence[str] = fv.JUDGE_DIMENSIONS) -> DataFrame:
    """Long (dimension, human, judge) rows of messages scored on both sides."""
    h = human.select(id_col, *[F.col(f"{d}_score").cast("double").alias(f"{d}_human") for d in dimensions])
    j = judge.select(id_col, *[F.col(f"{d}_score").cast("double").alias(f"{d}_llm") for d in dimensions])
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(f"{d}_human").alias("human"), F.col(f"{d}_llm").alias("judge"))
        for d in dimensions
    ])
    return h.join(j, id_col).select(F.explode(pairs).alias("p")).select("p.*")


def judge_agreement(pairs: DataFrame) -> DataFrame:
    """(dimension, n, spearman_rho, spearman_p, adjacent_rate).

    Rows with a blank score on either side are left out. The others collapse to counted (human, judge) cells first;
    average ranks come from the cells, so no task ranks all the rows of a dimension.
    """
    cells = pairs.filter(F.col("human").isNotNull() & F.col("judge").isNotNull()).groupBy("dimension", "human", "judge").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("dimension")

    def rank(side: str) -> Column:
        ties = F.sum("n").over(Window.partitionBy("dimension", side))
        return F.sum("n").over(whole.orderBy(side)) - ties + (ties + 1) / 2

    ranked = cells.withColumns({"rh": rank("human"), "rj": rank("judge")}).withColumn("total", F.sum("n").over(whole))
    mid, n = (F.col("total") + 1) / 2, F.col("n")
    dh, dj = F.col("rh") - mid, F.col("rj") - mid
    sums = ranked.groupBy("dimension").agg(
        F.max("total").alias("n"), F.sum(n * dh * dj).alias("hj"), F.sum(n * dh * dh).alias("hh"),
        F.sum(n * dj * dj).alias("jj"),
        (F.sum(F.when(F.abs(F.col("human") - F.col("judge")) <= 1, n).otherwise(0)) / F.sum(n)).alias("adjacent_rate"),
    )
    rho = F.try_divide(F.col("hj"), F.sqrt(F.col("hh") * F.col("jj")))
    rho = F.when(rho.isNotNull(), F.greatest(F.least(rho, F.lit(1.0)), F.lit(-1.0)))
    return sums.withColumn("spearman_rho", rho).select(
        "dimension", "n", "spearman_rho", two_sided_p(F.col("spearman_rho"), F.col("n")).alias("spearman_p"), "adjacent_rate"
    )


def agreement_lines(agreement: DataFrame) -> DataFrame:
    cells = [
        F.col("dimension"), F.format_string("%.3f", "spearman_rho"), F.format_string("%.3f", "spearman_p"),
        F.concat(F.format_string("%.1f", F.col("adjacent_rate") * 100), F.lit("%")),
    ]
    return agreement.select("dimension", table_line(cells).alias("line"))


def missing_scores(scores: DataFrame, dimensions: Sequence[str] = fv.JUDGE_DIMENSIONS) -> DataFrame:
    blank = F.lit(False)
    for d in dimensions:
        blank = blank | F.col(f"{d}_score").isNull()
    return scores.agg(F.count("*").alias("n_rows"), F.count_if(blank).alias("n_missing"))


def require_scores(scores: DataFrame) -> None:
    """Refuse to go on while any score is blank."""
    n = missing_scores(scores).first()["n_missing"]
    if n:
        raise ValueError(f"{n} row(s) still have a blank score")


def dimension_summary(scores: DataFrame, dimensions: Sequence[str] = fv.JUDGE_DIMENSIONS) -> DataFrame:
    long = scores.unpivot([], [f"{d}_score" for d in dimensions], "dimension", "score")
    return long.groupBy(F.regexp_replace("dimension", "_score$", "").alias("dimension")).agg(
        F.count("score").alias("n"), F.avg("score").alias("mean"), F.stddev_samp("score").alias("std")
    )


def scoring_template(sample: DataFrame, dimensions: Sequence[str] = fv.JUDGE_DIMENSIONS) -> DataFrame:
    return sample.select(
        "customer_tweet_id", "hard_case_category", "tweet_text", "drafted_reply",
        *[F.lit(None).cast("double").alias(f"{d}_score") for d in dimensions],
    )


def policy_leaks(decided: DataFrame, high_risk: Sequence[str] = fv.HIGH_RISK_INTENTS) -> DataFrame:
    """Overridden or high-risk rows that were still handled automatically (expected: none)."""
    leak = (F.col("escalation_decision") == "auto") & (
        F.col("fraud_override") | F.col("predicted_intent").isin(*high_risk)
    )
    return decided.agg(F.count("*").alias("n_rows"), F.count_if(leak).alias("n_leaked"))


def flag_rate(drafts: DataFrame, kind: str, checked: Column) -> DataFrame:
    """Share of checked drafts that carry a flag of ``kind``."""
    hit = F.exists("validate_draft_flags", lambda f: f["kind"] == kind)
    rows = drafts.filter(checked)
    return rows.agg(F.count("*").alias("n_checked"), F.count_if(hit).alias("n_flagged"), F.avg(hit.cast("double")).alias("rate"))
