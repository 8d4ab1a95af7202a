"""Batches that are appended once, the feature cache, and typed re-reads."""

import hashlib
import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_triage.session import shared_folder, staged
from spark_triage.sources import batches, feature_cache as fc, typed

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])


def frame(spark, ids):
    return spark.createDataFrame([(i, f"t{i}") for i in ids], SCHEMA)


def ids_of(spark, path):
    return sorted((r.batch, r.id) for r in batches.read_batches(spark, path, SCHEMA).collect())


def test_a_batch_that_is_run_twice_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ids_of(spark, path) == []
    assert batches.append_once(frame(spark, [1, 2, 2]), path, "a") and batches.append_once(frame(spark, [3]), path, "b")
    assert not batches.append_once(frame(spark, [2, 1, 2]).repartition(3), path, "a")
    assert ids_of(spark, path) == [("a", 1), ("a", 2), ("a", 2), ("b", 3)]
    assert {r.batch: (r.rows, r.found) for r in batches.check_batches(spark, path, SCHEMA).collect()} == {"a": (3, 3), "b": (1, 1)}


def test_other_rows_under_a_committed_name_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    batches.append_once(frame(spark, [1, 2]), path, "a")
    for other in ([1], [1, 3], [1, 2, 2]):
        with pytest.raises(ValueError, match="other rows"):
            batches.append_once(frame(spark, other), path, "a")


def test_a_run_that_was_lost_half_way_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [1]).write.parquet(f"{path}/data/batch=a/attempt=lost")
    assert ids_of(spark, path) == []
    assert batches.append_once(frame(spark, [1, 2]), path, "a")
    assert ids_of(spark, path) == [("a", 1), ("a", 2)]


def test_an_empty_batch_is_committed(spark, tmp_path):
    path = str(tmp_path / "t")
    assert batches.append_once(frame(spark, [1]).limit(0), path, "none")
    assert not batches.append_once(frame(spark, [1]).limit(0), path, "none")
    assert ids_of(spark, path) == []


TEXTS = [(1, "red red blue"), (2, "blue green"), (3, ""), (4, None), (5, "Red, x zz")]


def brute_vectors(rows, reference, dims):
    import hashlib
    import re

    terms = lambda t: Counter(re.findall(r"\w{2,}", (t or "").lower()))
    df = Counter(x for _, t in reference for x in terms(t))
    idf = lambda x: math.log((1 + len(reference)) / (1 + df.get(x, 0))) + 1
    out = {}
    for i, t in rows:
        v = [0.0] * dims
        for x, n in terms(t).items():
            h = hashlib.md5(x.encode()).hexdigest()
            v[int(h[:8], 16) % dims] += n * idf(x) * (1 if int(h[8], 16) % 2 == 0 else -1)
        norm = math.sqrt(sum(a * a for a in v))
        out[i] = [a / norm if norm else 0.0 for a in v]
    return out


def test_hashed_vectors(spark):
    df = spark.createDataFrame(TEXTS, "id bigint, t string")
    weights = staged(fc.term_weights(df, "id", "t"), "weights")
    for rows in (TEXTS, TEXTS[:1] + [(9, "unseen red")]):  # a text has the same vector whatever stands beside it
        got = {r.id: r.embedding for r in fc.hashed_vectors(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", weights, 8).collect()}
        want = brute_vectors(rows, TEXTS, 8)
        assert set(got) == set(want) and all(got[i] == pytest.approx(want[i]) for i in want)


def test_weights_are_sent_or_met_by_a_shuffle(spark):
    rows = [(1, "late parcel late"), (1, "parcel again"), (2, "money back"), (2, "money back"), (None, "late word"), (None, "word"), (3, None), (4, "x")]
    df = spark.createDataFrame(rows, "id bigint, t string").repartition(3)
    weights = staged(fc.term_weights(df, "id", "t"), "weights")
    n = {"late": 2, "parcel": 1, "again": 1, "money": 1, "back": 1, "word": 1}  # rows without an id count as one text
    assert {r.term: r.idf for r in weights.collect()} == pytest.approx({t: np.log(5 / (1 + c)) + 1 for t, c in n.items()})
    sent, met = fc.hashed_vectors(df, "id", "t", weights, 8), fc.hashed_vectors(df, "id", "t", weights, 8, sent_bytes=0)
    got, want = ({r.id: r.embedding for r in x.collect()} for x in (sent, met))
    assert got.keys() == {1, 2, 3, 4} and all(got[i] == pytest.approx(want[i]) for i in got)
    by_term = lambda x: re.search(r"hashpartitioning\(id#\d+L?, term#", x._jdf.queryExecution().executedPlan().toString())
    assert by_term(met) and not by_term(sent)


def test_only_rare_terms_move_where_the_vocabulary_is_too_large_to_send(spark):
    rows = [(i, f"common common often{i % 3} rare{i}") for i in range(30)] + [(1, "again rare1"), (40, None), (None, "lost")]
    df = spark.createDataFrame(rows, "id bigint, t string").repartition(3)
    weights = staged(fc.term_weights(df, "id", "t"), "weights")
    weights_of = {r.term: r.idf for r in weights.collect()}
    few = sum(len(t) + 40 for t in ("common", "often0", "often1", "often2"))
    written = lambda: {str(x) for x in Path(shared_folder(spark)).glob("slot-sums-*")}
    before = written()
    got = {r.id: r.embedding for r in fc.hashed_vectors(df, "id", "t", weights, 8, sent_bytes=few + 9).collect()}
    moved = spark.read.parquet(*(written() - before)).filter("term is not null")
    assert {r.term for r in moved.collect()} == {"again", *(f"rare{i}" for i in range(30))}
    want = {r.id: r.embedding for r in fc.hashed_vectors(df, "id", "t", weights, 8).collect()}
    assert got.keys() == want.keys() == {*range(30), 40} and all(got[i] == pytest.approx(want[i]) for i in want)
    v = [0.0] * 8
    for x, n in {"common": 2, "often1": 1, "rare1": 2, "again": 1}.items():
        h = hashlib.md5(x.encode()).hexdigest()
        v[int(h[:8], 16) % 8] += n * weights_of[x] * (1 if int(h[8], 16) % 2 == 0 else -1)
    assert got[1] == pytest.approx([x / math.sqrt(sum(y * y for y in v)) for x in v]) and got[40] == [0.0] * 8


def test_equal_weights_of_opposite_sign_cancel_in_any_order(spark):
    found = {1: [], -1: []}
    for i in range(400):
        h = hashlib.md5(f"w{i}".encode()).hexdigest()
        if int(h[:8], 16) % 8 == 0:
            found[1 if int(h[8], 16) % 2 == 0 else -1].append(f"w{i}")
    (a, b, c), (x, y, z) = found[1][:3], found[-1][:3]
    rows = [(1, f"{a} {b} {c} {x} {y} {z}"), (2, f"{z} {a} {y} {c} {x} {b}"), (3, f"{a} {a} {a} {y} {x} {z}"), (4, f"{a} {b} {x}")]
    weights = spark.createDataFrame([(t, w, 9.0) for t, w in zip((a, x, b, y, c, z), (1.1, 1.1, 2.3, 2.3, 3.7, 3.7))], "term string, idf double, idf_unseen double")
    for df in (spark.createDataFrame(rows, "id bigint, t string"), spark.createDataFrame(rows[::-1], "id bigint, t string").repartition(3)):
        got = {r.id: r.embedding for r in fc.hashed_vectors(df, "id", "t", weights, 8).collect()}
        assert got == {1: [0.0] * 8, 2: [0.0] * 8, 3: [-1.0] + [0.0] * 7, 4: [1.0] + [0.0] * 7}


def test_a_merge_sends_ids_and_leaves_texts_where_they_are(spark):
    named = staged(spark.createDataFrame([(i, f"t{i}") for i in range(40)], "id bigint, t string"), "named")
    shuffled = lambda df: "hashpartitioning(id" in df._jdf.queryExecution().executedPlan().toString()
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for ids in (range(3), range(2, 40), range(40), ()):
            todo = staged(spark.createDataFrame([(i,) for i in ids], "id bigint"), "todo")
            few = fc._chosen(named, todo, "id", 42 * 5)  # the ids of five rows at most are sent
            moved = fc._chosen(named, todo, "id", -1)
            assert not shuffled(few) and shuffled(moved)
            assert sorted(map(tuple, few.collect())) == sorted(map(tuple, moved.collect())) == [(i, f"t{i}") for i in ids]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_an_id_of_several_rows_has_its_greatest_text(spark):
    rows = [(1, "a"), (2, "b"), (2, "c"), (2, None), (3, None), (4, None), (4, None), (None, "x"), (5, "d"), (5, "d")]
    df = spark.createDataFrame(rows, "id bigint, t string").repartition(3)
    for most in (fc.SENT_BYTES, 0):
        got = fc._one_text(df, "id", "t", most).collect()
        assert sorted((r.id, r.t or "") for r in got) == [(1, "a"), (2, "c"), (3, ""), (4, ""), (5, "d")]


def test_a_merge_does_not_shuffle_texts_of_ids_that_come_once(spark):
    asked = []

    def encode(rows):
        asked.append(rows)
        return rows.select("id", F.array(F.length("t").cast("double")).alias("embedding"))

    df = staged(spark.createDataFrame([(i, f"t{i}") for i in range(40)], "id bigint, t string"), "rows")
    cache = staged(fc.merge_cache(fc.empty_cache(df, "id"), df, "id", "t", "m", 1, encode), "cache")
    assert sorted(r.id for r in fc.merge_cache(cache, df, "id", "t", "m", 2, encode).collect()) == list(range(40))
    plan = asked[0]._jdf.queryExecution().optimizedPlan().toString()
    first = plan.index("LeftAnti")  # ids that come once: no aggregate above, no exchange below
    assert "Aggregate" not in plan[:first] and asked[0].count() == 40 and asked[1].count() == 0


def test_merge_encodes_what_changed_and_repeats_without_effect(spark):
    asked = []

    def encode(rows):
        asked.append(sorted(r.id for r in rows.collect()))
        return rows.select("id", F.array(F.length("t").cast("double")).alias("embedding"))

    def merge(cache, rows, model, version):
        df = spark.createDataFrame(rows, "id bigint, t string")
        return staged(fc.merge_cache(cache, df, "id", "t", model, version, encode), "cache")

    start = fc.empty_cache(spark.createDataFrame(TEXTS, "id bigint, t string"), "id")
    one = merge(start, [(1, "aa"), (2, "b"), (2, "b"), (None, "x")], "m1", 1)
    two = merge(one, [(1, "aa"), (2, "bbb"), (3, "c")], "m1", 2)
    again = merge(two, [(1, "aa"), (2, "bbb"), (3, "c")], "m1", 3)
    other = merge(again, [(1, "aa")], "m2", 4)
    assert asked == [[1, 2], [2, 3], [], [1]]
    rows = lambda df: sorted((r.id, r.model_version, r.version, r.embedding[0]) for r in df.collect())
    assert rows(two) == rows(again) == [(1, "m1", 1, 2.0), (2, "m1", 2, 3.0), (3, "m1", 2, 1.0)]
    assert rows(other) == [(1, "m1", 1, 2.0), (1, "m2", 4, 2.0), (2, "m1", 2, 3.0), (3, "m1", 2, 1.0)]


DECLARED = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("n", T.LongType()), T.StructField("f", T.DoubleType()),
    T.StructField("b", T.BooleanType()), T.StructField("gone", T.StringType())])
CSV = 'n,id,f,b,more\n1,10,0.5,true,x\nbad,11,1e3,maybe,y\n,12,,,"two\nlines"\n9999999999999999999999,x,nan,false,\n'


def test_cells_that_do_not_fit_are_listed(spark, tmp_path):
    (tmp_path / "t.csv").write_text(CSV)
    read = typed.read_typed_csv(spark, str(tmp_path), DECLARED, "id")
    assert [f.dataType for f in read.rows.schema] == [f.dataType for f in DECLARED]
    rows = {r.id: (r.n, r.f, r.b, r.gone) for r in read.rows.filter("id is not null").collect()}
    assert rows == {10: (1, 0.5, True, None), 11: (None, 1000.0, None, None), 12: (None, None, None, None)}
    assert read.rows.count() == 4
    assert sorted(map(tuple, read.rejects.collect())) == [
        ("11", "b", "not a boolean", "maybe"), ("11", "n", "not a bigint", "bad"),
        ("x", "id", "not a bigint", "x"), ("x", "n", "not a bigint", "9999999999999999999999")]
    assert sorted(map(tuple, read.drift.collect())) == [("gone", "missing", "string", None), ("more", "extra", None, "string")]
    with pytest.raises(ValueError, match="gone"):
        typed.require_typed(read)


def test_typed_reread_of_a_table_whose_types_moved(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "7", 1.0), (2, "x", 2.5)], "id int, n string, f float").write.parquet(path)
    schema = T.StructType.fromDDL("id bigint, n int, f double")
    read = typed.read_typed(spark, path, schema, "id")
    assert sorted(map(tuple, read.rows.collect())) == [(1, 7, 1.0), (2, None, 2.5)]
    assert [tuple(r) for r in read.rejects.collect()] == [("2", "n", "not a int", "x")]
    assert {(r.column, r.change) for r in read.drift.collect()} == {("id", "type"), ("n", "type"), ("f", "type")}
    fine = typed.read_typed(spark, path, spark.read.parquet(path).schema, "id")
    assert typed.require_typed(fine).count() == 2


def test_a_null_key_where_one_is_declared(spark):
    df = spark.createDataFrame([(None, "a"), ("3", "b")], "id string, t string")
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("t", T.StringType())])
    read = typed.fit(df, schema, "id")
    assert [tuple(r) for r in read.rejects.collect()] == [(None, "id", "empty", None)]
