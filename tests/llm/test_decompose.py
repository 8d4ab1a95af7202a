import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from spark_triage.llm import decompose  # noqa: E402
from tests.llm.test_tokens import library, spec_of  # noqa: E402

SPEC = "byte_bpe_50k.json"


def test_cuts_are_the_binary_digits():
    total = np.array([1, 2, 3, 1023, 1024, 1025, 5000])
    doc, start, length = decompose.cuts(total, 1024)
    for i, n in enumerate(total.tolist()):
        own = length[doc == i].tolist()
        assert own == [1024] * (n // 1024) + [1 << k for k in range(9, -1, -1) if n % 1024 >> k & 1]
        assert start[doc == i].tolist() == [sum(own[:k]) for k in range(len(own))] and sum(own) == n


@pytest.mark.parametrize("size", [8, 1024])
def test_sequences_hold_every_id_once_and_no_two_documents(frame, corpus, size):
    rows = decompose.sequences(frame, spec_of(SPEC), size=size).collect()
    want = {d: [*x, 0] for (d, _), x in zip(corpus, library(spec_of(SPEC), [t for _, t in corpus])[0])}
    got = {d: {} for d in want}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.length & (r.length - 1) == 0 and r.length <= size
        assert r.doc_tokens == len(want[r.doc_id]) and r.offset == 0
        got[r.doc_id][r.start] = ids
    assert {d: [x for s in sorted(p) for x in p[s]] for d, p in got.items()} == want
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_digest(frame):
    rows = decompose.sequences(frame, spec_of(SPEC))
    want = {(r.doc_id, r.start): zlib.crc32(r.ids) for r in rows.collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in decompose.digest(rows).collect()} == want


def test_repeated_rows_null_ids_and_empty_table(spark, empty):
    rows = spark.createDataFrame([(None, "a b c", 1), (None, "a b c", 1), (1, None, 2), (1, None, 2), (1, "", 3)],
                                 "doc_id long, text string, length int")
    got = decompose.sequences(rows, spec_of(SPEC)).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 4), (0, 4), (1, 1), (1, 1), (1, 1)]
    assert decompose.digest(decompose.sequences(empty, spec_of(SPEC))).collect() == []


def test_size_must_be_a_power_of_two(empty):
    with pytest.raises(ValueError):
        decompose.sequences(empty, spec_of(SPEC), size=1000)
