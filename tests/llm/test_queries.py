"""The registered queries and the pipeline over the smallest tables."""

import hashlib
import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.run import TABLES, rows_of
from spark_triage.llm import queries
from tests.llm import brute
from tests.llm.test_repair import measured
from tests.llm.test_tokens import check_packed, library, spec_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    want = con.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


def test_op4(spark, docs):
    ids, t = library(spec_of("byte_bpe_50k.json"), docs.values())
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = {d: (len(x), sha(np.array(x, "<u4").tobytes()), sha(t.decode(x, skip_special_tokens=False).encode()))
            for d, x in zip(docs, ids)}
    assert {r.doc_id: tuple(r)[1:] for r in result(spark, "op4_word_table")} == want


def test_op5(spark, docs):
    rows = result(spark, "op5_sharding")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    sizes = [sum(r.shard == s for r in rows) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_op6(spark, docs):
    at, want = 0, {}
    ids = dict(zip(docs, library(spec_of("word_bpe_49k.json"), docs.values())[0]))
    for d in sorted(docs):
        raw = np.array([*ids[d], 2], "<u4")
        want[d] = (at, len(raw), zlib.crc32(raw.tobytes()))
        at += len(raw)
    assert {r.doc_id: tuple(r)[1:] for r in result(spark, "op6_id_files")} == want


def test_op7(spark, docs):
    ids = {d: np.array([*x, 2], "<u4") for d, x in zip(docs, library(spec_of("byte_bpe_50k.json"), docs.values())[0])}
    rows = result(spark, "op7_best_fit_packing")
    assert check_packed(rows, ids, 1024) <= 1.01 * (1 + sum(map(len, ids.values())) / 1024)


def test_op8(spark, docs):
    ids = library(spec_of("byte_bpe_50k.json"), docs.values())[0]
    want = {d: (len((t or "").encode()), len(x), len(x) > 512) for (d, t), x in zip(docs.items(), ids)}
    assert {r.doc_id: tuple(r)[1:] for r in result(spark, "op8_token_counts")} == want


def test_op9(spark, docs):
    for r in result(spark, "op9_personal_data"):
        base = brute.personal(docs[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.named(base))
        assert set(filter(None, brute.named(base).split(","))) <= set(r.spans.split(","))


def test_op12(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in result(spark, "op12_conversation_repair")} == measured(rows)


def test_op13(spark, docs):
    ids = {d: np.array([*x, 0], "<u4") for d, x in zip(docs, library(spec_of("byte_bpe_50k.json"), docs.values())[0])}
    rows = result(spark, "op13_power_of_two_packing")
    want = {d: [1024] * (len(x) // 1024) + [1 << k for k in range(9, -1, -1) if len(x) % 1024 >> k & 1] for d, x in ids.items()}
    assert {d: [r.length for r in sorted(own, key=lambda r: r.start)] for d, own in brute.groups(rows, lambda r: r.doc_id).items()} == want
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.offset == 0 for r in rows)
    assert all(r.doc_tokens == len(ids[r.doc_id]) for r in rows) and len({r.sequence_id for r in rows}) == len(rows)


def test_pipeline_stages_against_their_plain_versions(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    now = {r.doc_id: r.text for r in table.collect()}
    measured = {d: brute.measures(t) for d, t in now.items()}
    want = {d: now[d] for d, m in measured.items() if m[0] >= 10 and 100 * m[4] <= 20 * m[0]}
    df = common_staged(stages["quality rules"](spark, table, SF))
    assert texts(df) == want and df.columns == table.columns
    comp = brute.near(want.items())
    want = {d: t for d, t in want.items() if comp[d][1] == d}
    df = common_staged(stages["near-duplicates"](spark, df, SF))
    assert texts(df) == want and df.columns == table.columns
    rows = {d: (n, text) for d, _, n, text in brute.without_repeats(want.items())}
    want = {d: (rows[d][1] if rows[d][0] else t) for d, t in want.items() if rows[d][1] or not rows[d][0]}
    df = common_staged(stages["repeated passages"](spark, df, SF))
    assert texts(df) == want and df.columns == table.columns
    df = common_staged(stages["personal data"](spark, df, SF))
    assert df.columns == table.columns and df.schema == table.schema
    got = texts(df)
    assert set(got) == set(want)
    assert all(not brute.personal(t) for t in got.values())
    assert all(got[d] == t for d, t in want.items() if not brute.personal(t) and not any(c.isdigit() or c == "@" for c in t))
    packed = stages["best-fit packing"](spark, df, SF).collect()
    ids = {d: np.array([*x, 2], "<u4") for d, x in zip(got, library(spec_of("byte_bpe_50k.json"), got.values())[0])}
    check_packed(packed, ids, 1024)


def common_staged(df):
    from spark_triage.llm.common import staged

    return staged(df, "test")


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_pipeline_takes_any_rows(spark, frame, empty):
    for docs in (frame, empty):
        df = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = common_staged(stage(spark, df, SF))
            assert df.columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, df, SF).count()


def test_pipeline_runs_as_a_query(spark):
    rows = result(spark, "pipeline")
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].__fields__)
