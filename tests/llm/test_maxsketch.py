import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spark_triage.llm import maxsketch as ms
from tests.llm.conftest import prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] of (doc_id, text) and (item_id, text) rows, every document scored."""
    own = [(d, Counter(terms(t))) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    total, df = sum(n for *_, n in own), Counter(t for _, c, _ in own for t in c)
    weight = {t: math.floor(1000 * math.log((2 * len(own) + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        asked = set(terms(text)) & set(weight)
        scores = []
        for d, c, n in own:
            m = 10 + 90 * n * len(own) // total
            s = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.choice([0, 3, 20, 80, 400]))) for i in range(300)]
    docs += [(i, docs[i - 300][1]) for i in range(300, 320)] + [(5, docs[5][1])] * 3  # ties and repeated rows
    docs += [(None, docs[7][1]), (None, None), (400, None), (401, ""), (402, " .,;\n"), (403, "É é ß 中文 a-b A_b x" * 3)]
    docs += [(404, "over " * 70000), (405, " ".join(f"t{i}" for i in range(9000))), (406, "a" * 60000)]
    items = [(i, prose(rng, rng.choice([1, 4, 30]))) for i in range(40)]
    items += [(40, docs[9][1]), (41, "OVER the t8999 中文"), (42, None), (43, ""), (44, "nowhere_zzz"), (1, items[1][1]), (None, "an er ti")]
    return docs, items


def test_search_equals_scoring_every_document(spark, tables):
    docs, items = tables
    df = spark.createDataFrame([(*d, "x", 1.0) for d in docs], "doc_id long, text string, item string, score double").repartition(7)
    asked = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, rank int").repartition(3)
    want = sorted(ranked(docs, items), key=repr)
    assert found(ms.search(df, asked)) == want
    assert found(ms.search(df, asked, block_items=8)) == want  # several blocks
    assert found(ms.search(df, asked, k=3)) == sorted(ranked(docs, items, 3), key=repr)


def test_bounds_hold_and_most_documents_are_not_scored():
    rng = random.Random(9)
    words = lambda n: " ".join(f"w{int(rng.paretovariate(0.5)) % 5000}" for _ in range(n))
    docs = [words(rng.choice([20, 80, 300])) for _ in range(400)] + ["w1 " * 5000]
    items = [" ".join(rng.sample(docs[rng.randrange(400)].split(), 15)) for _ in range(20)]
    block = ms.Block.of([(i, next(iter(ms.term_counts(pa.array([t]))))[1].astype("<u8").tobytes()) for i, t in enumerate(items)])
    own = [next(iter(ms.term_counts(pa.array([t])))) for t in docs]
    n = np.array([int(x[3][0]) for x in own])
    block.weigh(Counter(int(i) for _, t, _, _ in own for i in np.flatnonzero(np.isin(block.vocabulary, t))), len(docs))
    search = ms.Search(block, np.ones(20), len(docs), int(n.sum()), 10)
    sizes = np.array([len(x[1]) for x in own])
    wide = ms.widths(sizes)
    sketches = []
    for (_, t, c, _), w in zip(own, wide.tolist()):
        s = np.zeros(w, np.uint8)
        np.maximum.at(s, (t & np.uint64(w - 1)).astype(np.int64), np.minimum(c, 255).astype(np.uint8))
        sketches.append(s)
    at, sketch_at = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(wide))
    bounds = search.bounds(np.concatenate(sketches), sketch_at, ms.lengths_part(n, len(docs), int(n.sum())))
    scores = {(r[0], r[2]): r[3] for r in ranked(list(enumerate(docs)), list(enumerate(items)), len(docs))}
    assert all(bounds[d, i] >= s for (i, d), s in scores.items())
    search.add(np.arange(len(docs)), np.zeros(len(docs), bool), n, np.concatenate([x[1] for x in own]), at,
               np.concatenate([x[2] for x in own]), np.concatenate(sketches), sketch_at)
    assert [(r["item"], r["doc_id"], r["score"]) for r in search.found().to_pylist()] == [
        (i, d, s) for i, _, d, s in ranked(list(enumerate(docs)), list(enumerate(items)))]
    assert search.scored < 0.4 * len(docs) * len(items)


def test_lengths_beyond_64_bits():
    n = np.array([1, 10**9])
    assert ms.lengths_part(n, 10**11, 10**13).tolist() == [10, 10 + 90 * 10**9 * 10**11 // 10**13]


def test_empty_tables(spark, empty, tables):
    docs, items = tables
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(ms.search(empty, asked)) == [] and found(ms.search(df, asked.limit(0))) == []
