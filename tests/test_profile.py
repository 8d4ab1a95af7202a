import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_triage.operators import profile as pf

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("name, values", [
    ("even", np.linspace(-1, 1, 10_001)),
    ("hot value", np.r_[np.full(7000, 0.9), np.linspace(0, 1, 3001)]),
    ("outlier", np.r_[np.linspace(0, 1, 5000), [1e12]]),
    ("two", np.array([1.0, 2.0])), ("one", np.array([3.5])),
])
def test_exact_quantiles(spark, name, values):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)], "v double").repartition(5)
    got = {r.prob: r.value for r in pf.exact_quantiles(df, "v", PROBS).collect()}
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_quantiles_with_a_coarse_sketch(spark):
    """A sketch that is far too coarse still leads to exact values."""
    values = np.random.default_rng(2).normal(size=20_000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(8)
    got = {r.prob: r.value for r in pf.exact_quantiles(df, "v", [0.25, 0.5], accuracy=200).collect()}
    assert [got[0.25], got[0.5]] == pytest.approx(list(np.quantile(values, [0.25, 0.5])), rel=1e-12)


def test_quantiles_of_several_columns(spark):
    """Columns of different sizes, with nulls, repeated values and nothing at all, from three reads."""
    rng = np.random.default_rng(4)
    columns = {"a": rng.normal(size=3000), "b": np.r_[np.full(2000, 0.9), np.linspace(0, 1, 500)], "c": np.array([2.0]), "d": np.array([])}
    rows = [tuple(float(v[i]) if i < len(v) else None for v in columns.values()) for i in range(3000)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    schema = "a double, b double, c double, d double"
    df = spark.createDataFrame(rows, schema).repartition(4).mapInArrow(count, schema)
    got = {(r["column"], r.prob): r.value for r in pf.exact_quantiles_of(df, list(columns), PROBS).collect()}
    assert got == {(c, p): pytest.approx(float(np.quantile(v, p)), rel=1e-12) for c, v in columns.items() if len(v) for p in PROBS}
    assert seen.value == 3 * 3000


def test_thresholds_and_profile(spark):
    df = spark.createDataFrame([(c, s) for c, s in zip([0.9] * 6 + [0.7, 0.95], np.linspace(0.6, 0.95, 8).tolist())],
                               "c double, s double")
    t = {r.threshold: r.value for r in pf.derive_thresholds(df, "c", "s").collect()}
    assert t == {"min_confidence": 0.9, "min_similarity": round(float(np.quantile(np.linspace(0.6, 0.95, 8), 0.25)), 2)}
    points = {(r.score, r.point) for r in pf.score_profile(df, ["c", "s"]).collect()}
    assert len(points) == 10


def test_sample_sanity(spark):
    full = spark.range(10).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("brand_reply_clean"), (F.col("id") < 4).alias("has_link"))
    rows = {r.set: r for r in pf.sample_sanity(full, full.filter("has_link")).collect()}
    assert (rows["full"].n, rows["full"].mean_len, rows["full"].median_len, rows["full"].link_rate) == (10, 4.5, 4.5, 0.4)
    assert (rows["working"].n, rows["working"].mean_len, rows["working"].link_rate) == (4, 1.5, 1.0)


def test_pii_counts(spark):
    df = spark.createDataFrame([("a@b.co", "x"), ("12 34 56 78 90", "a&#64;b.co"), ("none", None)], "c string, b string")
    assert tuple(pf.pii_affected(df, ["c", "b"]).first()) == (2, 1)
    assert tuple(pf.pii_residue(df, ["c", "b"]).first()) == (2, 0)


def test_flag_examples(spark):
    df = spark.createDataFrame([(3, "c", True), (1, "a", True), (2, "b", False)], "id int, t string, f boolean")
    assert sorted(map(tuple, pf.flag_examples(df, F.col("f"), "t", "id").collect())) == [(False, 2, "b"), (True, 1, "a")]
