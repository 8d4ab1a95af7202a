"""Encoding, counting, packing and id files against the tokenizers library on whole texts."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from spark_triage.llm import counts, idfiles, packing, wordtable  # noqa: E402
from spark_triage.llm import tokens as tk  # noqa: E402
from tests.llm.brute import groups  # noqa: E402

PARTS = ["a", "b", " ", "  ", "\n", "\t", "\xa0", "'s", "'", "é", "e", "́", "1", "23", ".", "!!", "<|endoftext|>",
         "<|startoftext|>", "don't", "\x1c", "\x85", "　", " ", "ß", "İ", "Σ", "中文", "😀", "the", "ing", " \n ", "\r\n",
         ",", "...", "?!", "Big", "THE", "<|ENDOFTEXT|>", "<|StartOfText|>", "K", "-", "…", ":;"]


def spec_of(name):
    return tk.read_vocabulary(public_tokenizers.path(name))


@pytest.fixture(scope="module")
def byte_spec():
    return spec_of("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def word_spec():
    return spec_of("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [None, "", "x" * 9000]


def library(spec, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)], t


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_ids_of_whole_texts(name, odd, corpus):
    spec = spec_of(name)
    texts = odd + [t for _, t in corpus]
    ids, at = tk.Encoder(spec).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library(spec, texts)[0]


def test_encoder_forgets_beyond_its_bound(byte_spec, odd, monkeypatch):
    monkeypatch.setattr(tk, "CACHE", 300)
    e = tk.Encoder(byte_spec)
    for at in range(0, 600, 40):
        ids, ends = e.encode(pa.array(odd[at : at + 40]))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == library(byte_spec, odd[at : at + 40])[0]


def test_white_space_of_the_word_pattern(byte_spec):
    """Every character is cut as the vocabulary cuts it."""
    texts = [f"a{chr(c)}{chr(c)}b {chr(c)} {chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    ids, at = tk.Encoder(byte_spec).encode(pa.array(texts))
    full = library(byte_spec, texts)[0]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == full
    counter = counts.Counter(byte_spec)
    assert [counter.whole(x) for x in texts] == [len(x) for x in full]


def test_token_counts(frame, corpus, byte_spec):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in counts.token_counts(frame, byte_spec).collect()}
    ids, _ = library(byte_spec, [t for _, t in corpus])
    assert got == {d: (len((t or "").encode()), len(x), len(x) > 512) for (d, t), x in zip(corpus, ids)}


def test_token_counts_of_odd_texts(spark, odd, byte_spec):
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_tokens for r in counts.token_counts(df, byte_spec).collect()}
    assert [got[i] for i in range(len(odd))] == [len(x) for x in library(byte_spec, odd)[0]]


def test_merging_in_rank_order():
    ranks = {(b"a", b"a"): 0, (b"aa", b"a"): 1, (b"b", b"aa"): 2}
    assert [counts.merged_length(w, ranks) for w in (b"", b"a", b"aa", b"aaa", b"aaaa", b"baa", b"baaa", b"c")] == [0, 1, 1, 1, 2, 1, 2, 1]


def test_counts_need_a_byte_level_vocabulary(frame, word_spec):
    with pytest.raises(ValueError):
        counts.token_counts(frame, word_spec)


@pytest.mark.parametrize("parts,size", [(256, 8 << 20), (5, 3000)])
def test_word_table(spark, odd, corpus, byte_spec, parts, size):
    texts = odd + [t for _, t in corpus]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    ids, library_ = library(byte_spec, texts)
    rows = wordtable.encoded(df, byte_spec, parts=parts, block_bytes=size)
    got = {r.doc_id: r for r in rows.collect()}
    assert len(got) == len(texts)
    assert all(list(got[i].ids) == x and got[i].decoded == (texts[i] or "") for i, x in enumerate(ids))
    digests = {r.doc_id: tuple(r)[1:] for r in wordtable.encoded(df, byte_spec, digest=True, parts=parts, block_bytes=size).collect()}
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    assert all(digests[i] == (len(x), sha(np.array(x, "<u4").tobytes()), sha(library_.decode(x, skip_special_tokens=False).encode()))
               for i, x in enumerate(ids))


def test_decoding_by_join(spark, byte_spec):
    rows = [(1, [15496, 995, 50256]), (1, [15496]), (2, []), (3, None), (4, [99999])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = sorted(tuple(r) for r in wordtable.decode(df, byte_spec).collect())
    assert got == [(1, "Hello"), (1, "Hello world<|endoftext|>"), (2, ""), (3, ""), (4, "")]


def test_nothing_to_encode(empty, byte_spec, word_spec):
    assert wordtable.encoded(empty, byte_spec).collect() == []
    assert counts.token_counts(empty, byte_spec).collect() == []
    assert packing.pack(empty, byte_spec).collect() == []
    assert idfiles.round_trip(empty, word_spec).collect() == []


@pytest.mark.parametrize("bits", [1, 5, 8, 15, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 777, dtype=np.uint64).astype("<u4")
    raw = idfiles.pack_bits(ids, bits)
    assert len(raw) == -(-777 * bits // 8)
    assert (idfiles.unpack_bits(raw, 777, bits) == ids).all()


def test_fewest_bits():
    assert [idfiles.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_random_access(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 3000, n, dtype=np.uint32) for n in rng.integers(0, 900, 200)]
    w = idfiles.Writer(f"{tmp_path}/x/a.ids", 12, block_ids=64)
    for i, ids in enumerate(docs):
        w.add(3 * i - 50, ids)
    w.close()
    r = idfiles.Reader(f"{tmp_path}/x/a.ids")
    assert r.docs.tolist() == [3 * i - 50 for i in range(200)]
    for i in (0, 199, 3, 77):
        assert r.document(i).tolist() == docs[i].tolist()
    whole = np.concatenate(docs)
    for lo, hi in ((0, len(whole)), (63, 65), (64, 128), (1000, 1000), (len(whole) - 1, len(whole))):
        assert r.ids(lo, hi).tolist() == whole[lo:hi].tolist()


@pytest.mark.parametrize("size", [32 << 20, 4000])
def test_id_files(frame, corpus, word_spec, size):
    got = {r.doc_id: tuple(r)[1:] for r in idfiles.round_trip(frame, word_spec, file_bytes=size, block_ids=100).collect()}
    at = 0
    for (d, _), ids in zip(corpus, library(word_spec, [t for _, t in corpus])[0]):
        assert got[d] == (at, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
        at += len(ids) + 1
    assert len(got) == len(corpus)


def test_id_files_with_repeated_and_null_ids(spark, word_spec):
    df = spark.createDataFrame([(5, "b"), (None, "a"), (5, "b"), (5, "c c"), (-3, None)], "doc_id long, text string")
    got = sorted(((r.start, r.doc_id, r.n_tokens) for r in idfiles.round_trip(df, word_spec).collect()))
    assert [x[1] for x in got] == [None, -3, 5, 5, 5]
    assert [x[0] for x in got] == [sum(y[2] for y in got[:i]) for i in range(5)]


def test_id_files_are_bounded_in_bytes(spark, word_spec, tmp_path):
    """Where text size follows the id, and where one id stands on many rows."""
    rows = [(i, "word " * (i * i // 40)) for i in range(300)] + [(7, f"some text {i} " * 20) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    files = idfiles.write_ids(df, word_spec, 2, str(tmp_path), file_bytes=20000)
    sizes = {}
    for r in files.collect():
        f = idfiles.Reader(r.uri)
        sizes[r.number] = [(int(d), f.document(i).tolist()) for i, d in enumerate(f.docs)]
    every = [d for n in sorted(sizes) for d, _ in sizes[n]]
    assert every == sorted(every) and len(every) == len(rows)
    text = {tuple(x): t for (_, t), x in zip(rows, library(word_spec, [t for _, t in rows])[0])}
    assert all(len(own) == 1 or sum(len(text[tuple(ids[:-1])]) for _, ids in own) <= 20000 for own in sizes.values())
    assert sum(any(d == 7 for d, _ in own) for own in sizes.values()) > 4


def check_packed(rows, ids, size):
    by = groups(rows, lambda r: r.doc_id)
    for d, x in ids.items():
        at = 0
        for i, r in enumerate(sorted(by[d], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == size)
            assert r.ids_crc32 == zlib.crc32(x[at : at + r.length].tobytes())
            at += r.length
        assert at == len(x) and (len(x) > size or len(by[d]) == 1)
    held = groups(rows, lambda r: r.sequence_id)
    for some in held.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(held)


def best_fit(lengths, size):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= x]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - x)
        else:
            gaps.append(size - x)
    return len(gaps)


@pytest.mark.parametrize("size", [1024, 50])
def test_packing(frame, corpus, byte_spec, size, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 40)
    rows = packing.pack(frame, byte_spec, size=size).collect()
    ids = {d: np.array([*x, 2], "<u4") for (d, _), x in zip(corpus, library(byte_spec, [t for _, t in corpus])[0])}
    assert check_packed(rows, ids, size) <= best_fit([r.length for r in rows], size)


def test_packing_keeps_repeated_rows(spark, byte_spec):
    df = spark.createDataFrame([(1, "a b")] * 7 + [(None, None)] * 3, "doc_id long, text string").repartition(3)
    rows = packing.pack(df, byte_spec, size=4).collect()
    assert sorted(r.length for r in rows) == [1, 1, 1] + [3] * 7
    assert len({(r.sequence_id, r.offset) for r in rows}) == 10
    assert len({r.sequence_id for r in rows}) == 7


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_length_once(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 64, 1024])
    hist = {rng.randint(1, size): rng.randint(1, 60) for _ in range(rng.choice([1, 5, 40]))}
    used = Counter()
    chosen = packing.plan(hist, size)
    for pattern, n in chosen:
        assert sum(pattern) <= size and n > 0
        for x in pattern:
            used[x] += n
    assert used == Counter(hist)
    assert sum(n for _, n in chosen) <= best_fit([x for x, n in hist.items() for _ in range(n)], size)


def test_gaps_are_filled_exactly():
    assert sorted(packing.plan({60: 2, 40: 1, 25: 1, 15: 1}, 100)) == [((60, 25, 15), 1), ((60, 40), 1)]
    assert packing.plan({70: 5, 12: 5, 10: 5, 8: 5}, 100) == [((70, 12, 10, 8), 5)]
    with pytest.raises(ValueError):
        packing.plan({101: 1}, 100)


def test_pieces_table_is_the_vocabulary(byte_spec):
    table, (_, t) = wordtable.piece_table(byte_spec), library(byte_spec, [])
    assert len(table) == t.get_vocab_size() == 1 + max(json.loads(byte_spec)["model"]["vocab"].values()) + 1
    for i in (0, 220, 1000, 50255, 50256):
        assert t.decode([i], skip_special_tokens=False) == table[i].decode("utf-8", "replace")
