import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.operators import evaluate as ev


def decisions(spark, tp, fp, fn, tn):
    rows = [("escalate", "escalate")] * tp + [("auto", "escalate")] * fp + [("escalate", "auto")] * fn + [("auto", "auto")] * tn
    return spark.createDataFrame([("m", "a", "a", t, p) for t, p in rows],
                                 "method string, true_intent string, pred_intent string, true_decision string, pred_decision string")


@pytest.mark.parametrize("cells, want", [
    ((60, 86, 9, 45), (0.411, 0.870, 0.558, 0.525)),
    ((69, 131, 0, 0), (0.345, 1.000, 0.513, 0.345)),
    ((3, 0, 66, 131), (1.000, 0.043, 0.083, 0.670)),
    ((0, 0, 5, 5), (0.0, 0.0, 0.0, 0.5)),
])
def test_published_escalation_numbers(spark, cells, want):
    r = ev.compare_methods(decisions(spark, *cells)).first()
    got = (r.escalation_precision, r.escalation_recall, r.escalation_f1, r.escalation_accuracy)
    assert tuple(round(x, 3) for x in got) == want


def test_published_macro_f1_of_a_constant(spark):
    rows = [("a", "a")] * 48 + [(c, "a") for c in "bcdefgh" for _ in range(22)][:152]
    df = spark.createDataFrame(rows, "t string, p string")
    report = ev.classification_report(df, "t", "p")
    assert round(report.agg(F.avg("f1")).first()[0], 3) == 0.048 and report.count() == 8
    assert round(ev.accuracy(df, "t", "p").first().accuracy, 3) == 0.240


def test_report_and_confusion_on_a_label_seen_on_one_side(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "z")], "t string, p string")
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in ev.classification_report(df, "t", "p").collect()}
    assert got == {"a": (0.5, pytest.approx(1 / 3), pytest.approx(0.4), 3), "b": (0.5, 1.0, pytest.approx(2 / 3), 1),
                   "c": (0.0, 0.0, 0.0, 1), "z": (0.0, 0.0, 0.0, 0)}
    cells = {(r.true_label, r.pred_label): r.n for r in ev.confusion_matrix(df, "t", "p").collect()}
    assert len(cells) == 16 and cells["a", "z"] == 1 and cells["z", "z"] == 0 and sum(cells.values()) == 5
    wide = {r.true_label: (r.a, r.b, r.z) for r in ev.confusion_wide(df, "t", "p", ["a", "b", "z"]).collect()}
    assert wide == {"a": (1, 1, 1), "b": (0, 1, 0), "c": (1, 0, 0)}


def test_method_rows(spark):
    golden = spark.createDataFrame([(i, "", "x", "auto", "y", "account_access", "auto") for i in range(4)],
                                   "customer_tweet_id bigint, hard_case_category string, true_intent string, true_escalation_decision string, "
                                   "predicted_intent string, simple string, escalation_decision string")
    pseudo = spark.createDataFrame([("q",), ("p",), ("q",), ("p",)], "predicted_intent string")
    got = {(r.method, r.pred_intent, r.pred_decision) for r in ev.method_rows(golden, pseudo, "simple").collect()}
    assert got == {("Trivial baseline", "p", "escalate"), ("Simple baseline", "account_access", "escalate"), ("Full system", "y", "auto")}
    line = ev.comparison_lines(ev.compare_methods(decisions(spark, 60, 86, 9, 45))).first().line
    assert line == "| m | 1.000 | 1.000 | 0.411 | 0.870 | 0.558 | 0.525 |"


@pytest.mark.parametrize("rho, want", [(0.407, 0.009), (0.375, 0.017), (0.397, 0.011), (0.451, 0.003)])
def test_published_p_values(spark, rho, want):
    assert round(spark.range(1).select(ev.two_sided_p(F.lit(rho), F.lit(40))).first()[0], 3) == want
    assert abs(spark.range(1).select(ev.two_sided_p(F.lit(-0.079), F.lit(40))).first()[0] - 0.630) < 0.005


def numeric_p(rho, n):
    """Tail of the t density by plain integration over the angle: t = sqrt(df) tan(x)."""
    df = n - 2
    x = np.linspace(math.asin(abs(rho)), math.pi / 2, 400_001)
    whole = np.linspace(0, math.pi / 2, 400_001)
    area = lambda g: np.trapezoid(np.cos(g) ** (df - 1), g)
    return area(x) / area(whole)


@pytest.mark.parametrize("n", [3, 4, 5, 6, 7, 12, 41, 42, 501, 5002])
def test_p_value_for_odd_and_even_degrees(spark, n):
    rhos = [0.0, 0.02, 0.3, 0.9]
    df = spark.createDataFrame([(r,) for r in rhos], "r double").select("r", ev.two_sided_p(F.col("r"), F.lit(n)).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(numeric_p(r.r, n), abs=1e-6)


def test_p_value_of_many_rows_and_limits(spark):
    row = spark.range(1).select(
        ev.two_sided_p(F.lit(0.02), F.lit(20_000)), ev.two_sided_p(F.lit(1.0), F.lit(40)), ev.two_sided_p(F.lit(-1.0), F.lit(40)),
        ev.two_sided_p(F.lit(None).cast("double"), F.lit(40)), ev.two_sided_p(F.lit(0.5), F.lit(2)),
        ev.two_sided_p(F.lit(0.01), F.lit(5003)), ev.two_sided_p(F.lit(0.01), F.lit(5002)),
    ).first()
    assert row[0] == pytest.approx(numeric_p(0.02, 20_000), abs=1e-6)
    assert row[1:5] == (0.0, 0.0, None, None)
    assert abs(row[5] - row[6]) < 1e-3


def test_p_values_that_are_tiny_or_of_very_many_rows(spark):
    """Values computed beforehand with the log-gamma function and 300 steps of the fraction."""
    t = lambda x, n: x / math.sqrt(n - 2 + x * x)
    cases = [(0.914, 341), (t(2, 1_000_002), 1_000_002), (t(5, 1_000_002), 1_000_002), (t(1, 1_000_000_002), 1_000_000_002),
             (t(30, 5002), 5002), (t(30, 5003), 5003)]
    df = spark.createDataFrame([(i, r, n) for i, (r, n) in enumerate(cases)], "i int, r double, n long")
    got = [x.p for x in df.select("i", ev.two_sided_p(F.col("r"), F.col("n")).alias("p")).orderBy("i").collect()]
    assert 0 < got[0] < 1e-100
    assert got[1] == pytest.approx(0.0455005338, rel=1e-8)
    assert got[2] == pytest.approx(5.733997868e-07, rel=1e-8)
    assert got[3] == pytest.approx(0.3173105081, rel=1e-8)
    assert 0 < got[5] < got[4] * 1.02 and got[4] < 1e-170


def test_agreement_leaves_blank_scores_out(spark):
    rows = [("d", 1.0, 1.0), ("d", 2.0, 2.0), ("d", 3.0, 3.0), ("d", None, 1.0), ("d", 4.0, None), ("d", 5.0, 5.0)]
    r = ev.judge_agreement(spark.createDataFrame(rows, "dimension string, human double, judge double")).first()
    assert (r.n, r.spearman_rho, r.spearman_p, r.adjacent_rate) == (4, 1.0, 0.0, 1.0)


def average_ranks(x):
    x = np.asarray(x)
    return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])


def test_agreement_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for d in ("one", "two", "constant"):
        h = rng.integers(1, 6, 60).astype(float)
        j = np.clip(h + rng.integers(-2, 3, 60), 1, 5) if d != "constant" else np.full(60, 3.0)
        rows += [(d, float(a), float(b)) for a, b in zip(h, j)]
        want[d] = (np.corrcoef(average_ranks(h), average_ranks(j))[0, 1] if d != "constant" else None, float((abs(h - j) <= 1).mean()))
    got = {r.dimension: r for r in ev.judge_agreement(spark.createDataFrame(rows, "dimension string, human double, judge double")).collect()}
    for d, (rho, adjacent) in want.items():
        assert got[d].n == 60 and got[d].adjacent_rate == pytest.approx(adjacent)
        assert got[d].spearman_rho == (pytest.approx(rho) if rho is not None else None)
        assert got[d].spearman_p == (pytest.approx(numeric_p(rho, 60), abs=1e-6) if rho is not None else None)


def scores(spark, blank=False):
    cols = ", ".join(f"{d}_score double" for d in fv.JUDGE_DIMENSIONS)
    return spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0, None if blank else 5.0), (2, 2.0, 2.0, 2.0, 2.0, 2.0)], f"customer_tweet_id bigint, {cols}")


def test_blank_scores_are_refused(spark):
    ev.require_scores(scores(spark))
    assert tuple(ev.missing_scores(scores(spark, True)).first()) == (2, 1)
    with pytest.raises(ValueError, match="1 row"):
        ev.require_scores(scores(spark, True))


def test_summary_and_pairs(spark):
    got = {r.dimension: (r.n, r.mean) for r in ev.dimension_summary(scores(spark, True)).collect()}
    assert got["relevance"] == (2, 1.5) and got["actionability"] == (1, 2.0) and set(got) == set(fv.JUDGE_DIMENSIONS)
    assert ev.score_pairs(scores(spark), scores(spark), "customer_tweet_id").count() == 10


def test_majority_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "x string")
    assert ev.majority_label(df, "x").first().x == "a"


def test_flag_rate(spark):
    df = spark.createDataFrame([(1, [("near_verbatim", "90%", 0.9)]), (2, []), (3, [("name", "Bob", None)]), (4, [])],
                               "id int, validate_draft_flags array<struct<kind:string,detail:string,score:double>>")
    assert tuple(ev.flag_rate(df, "near_verbatim", F.col("id") < 4).first()) == (3, 1, pytest.approx(1 / 3))
