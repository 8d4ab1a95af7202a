import hashlib

import pytest
from pyspark.sql import functions as F

from spark_triage.operators import sampling as sm


def key(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i


@pytest.mark.parametrize("n", [1, 7, 300, 1000, 5000])
def test_ranked_sample_is_the_seeded_order(spark, n):
    want = sorted(range(1000), key=lambda i: key(42, i))[:n]
    for parts in (1, 7):
        got = sm.ranked_sample(spark.range(1000).repartition(parts), "id", 42, n).collect()
        assert sorted((r.sample_rank, r.id) for r in got) == list(enumerate(want, 1))


def test_split_is_disjoint(spark):
    split = sm.split_working_heldout(spark.range(500), "id", 90, 40)
    order = sorted(range(500), key=lambda i: key(42, i))
    parts = {name: {r.id for r in split.filter(F.col("split") == name).collect()} for name in ("working", "heldout")}
    assert parts == {"working": set(order[:90]), "heldout": set(order[90:130])}
    assert sm.split_overlap(split, "id").first().n_overlap == 0


def test_quota_golden(spark):
    """45 over six groups, one of them with three rows, gives 8, 8, 8, 7, 3, 7."""
    sizes = {"": 160, "a": 10, "b": 10, "c": 10, "d": 3, "e": 10}
    rows = [(f"{g}{i}", g, n) for n, (g, size) in enumerate(sizes.items()) for i in range(size)]
    df = spark.createDataFrame([(i, g) for i, (_, g, _) in enumerate(rows)], "id bigint, g string")
    got = {r.g: r["count"] for r in sm.stratified_sample(df, "g", "id", 45, 33).groupBy("g").count().collect()}
    assert got == {"": 8, "a": 8, "b": 8, "c": 7, "d": 3, "e": 7}


def test_quota_remainder_goes_to_the_first_groups(spark):
    df = spark.range(800).select("id", (F.col("id") % 8).alias("g"))
    got = {r.g: r["count"] for r in sm.stratified_sample(df, "g", "id", 15, 13).groupBy("g").count().collect()}
    assert got == {**{g: 2 for g in range(7)}, 7: 1}


def test_more_groups_than_places(spark):
    df = spark.range(100).select("id", F.col("id").alias("g"))
    assert sorted(r.id for r in sm.stratified_sample(df, "g", "id", 15).collect()) == list(range(15))


@pytest.mark.parametrize("total", [30, 2400])
def test_stratified_rows_are_the_first_in_order(spark, total):
    """A total above the pre-shuffle bound goes through the salted parts and gives the same kind of rows."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("g"))
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append(r.id)
    base, rem = divmod(total, len(groups))
    want = {i for n, g in enumerate(sorted(groups))
            for i in sorted(groups[g], key=lambda i: key(9, i))[: base + (n < rem)]}
    assert {r.id for r in sm.stratified_sample(df, "g", "id", total, 9).collect()} == want


def test_forced_sample(spark):
    df = spark.range(200).select("id", (F.col("id") % 4).alias("g"), F.concat(F.lit("t"), "id").alias("t"))
    got = sm.forced_sample(df, "g", "id", "t", ["t3", "t11", "none"], 15, 13).collect()
    assert {r.id for r in got if r.forced} == {3, 11} and len(got) == 15


def test_lowest(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.1), (3, 0.1), (4, 0.9)], "id bigint, s double")
    assert [r.id for r in sm.lowest(df, "s", "id", 2).collect()] == [2, 3]


@pytest.mark.parametrize("n", [5, 700])
def test_a_sample_reads_its_input_once(spark, tmp_path, n):
    spark.range(20_000).repartition(16).write.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = spark.read.parquet(str(tmp_path / "t")).mapInArrow(count, "id long")
    got = sorted((r.sample_rank, r.id) for r in sm.ranked_sample(counted, "id", 42, n).collect())
    assert got == list(enumerate(sorted(range(20_000), key=lambda i: key(42, i))[:n], 1))
    assert seen.value == 20_000


def test_few_rows_leave_the_tasks(spark):
    keyed = spark.range(50_000).repartition(10).withColumn("_key", sm.hash_key("id", 1))
    assert 100 <= sm.bottom_rows(keyed, 100).count() <= 5000


def test_rows_without_an_id_are_not_drawn(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "id long")
    assert sorted(r.id for r in sm.seeded_sample(df, "id", 42, 5).collect()) == [1, 2]
    assert sm.seeded_sample(df.limit(0), "id", 42, 5).collect() == []
