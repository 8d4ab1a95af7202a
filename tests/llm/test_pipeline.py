"""Stages of the pipeline on rows that share an id, are repeated or have none."""

import random

import corpus_pipeline
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def frame_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", None, len(t)) for d, t in rows], SCHEMA).repartition(5)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(21)
    long, near, lone, short, both, other = (prose(rng, n) for n in (60, 200, 50, 12, 70, 45))
    altered = near.split()
    altered[100] = "changed"
    docs = frame_of(spark, [
        (3, long), (3, long), (3, long), (9, long), (None, long),  # the lowest id repeated, with copies
        (20, near), (20, near), (21, " ".join(altered)), (None, near),  # repeated, with a near copy
        (None, lone), (None, lone), (None, lone), (None, short), (None, short), (30, short), (30, short),
        (40, both), (40, other), (41, other),  # two texts of one id
    ])
    df = docs
    want = [(3, long), (20, near), (30, short), (40, both), (40, other), (None, lone)]
    for name in ("quality rules", "near-duplicates", "repeated passages", "personal data"):
        df = corpus_pipeline.staged(STAGES[name](spark, df, ""), "test")
        assert df.schema == docs.schema, name
        if name != "quality rules":
            assert rows_of(df) == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1])), name


def test_each_row_goes_by_its_own_verdict(spark):
    rng = random.Random(22)
    good, other = prose(rng, 40), prose(rng, 40)
    repeats = "the same five words again " * 12
    docs = frame_of(spark, [(None, "too short"), (None, repeats), (None, good), (1, "too short"), (1, good), (1, repeats), (2, other)])
    df = STAGES["quality rules"](spark, docs, "")
    assert df.schema == docs.schema
    assert rows_of(df) == [(1, good), (2, other), (None, good)]
