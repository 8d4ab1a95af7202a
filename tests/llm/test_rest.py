"""Quality, shards, personal data, top-k and the pipeline against their plain versions."""

import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_triage.llm import common, pii, quality, sharding, topk
from tests.llm import brute
from tests.llm.conftest import prose


def test_measures_and_verdicts(frame, corpus):
    got = {r.doc_id: r for r in quality.quality(frame).collect()}
    assert len(got) == len(corpus)
    for d, t in corpus:
        r, want = got[d], brute.measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and not r.host_rejected)
        assert d % 7 or not r.host_rejected  # no host, no verdict on it


def test_bad_hosts_take_their_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "too short" if i % 10 else good, "bad") for i in range(200)]
    rows += [(1000 + i, good if i % 20 else "x", f"host{i % 8}") for i in range(800)]
    rows += [(5000, good, "new"), (5001, "x", "tiny"), (5002, good, "tiny")]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not got[0].base_failed and not got[0].kept and got[0].host_rejected
    assert all(got[i].kept == bool((i - 1000) % 20) for i in range(1000, 1800))
    assert got[5000].kept and got[5002].kept


def test_prior_shrinks_by_what_hosts_differ(spark):
    same = spark.createDataFrame([(100, 10)] * 20, "n long, k long")
    apart = spark.createDataFrame([(100, 5)] * 10 + [(100, 95)] * 10, "n long, k long")
    a, b = quality.prior(same, "k")
    assert a / (a + b) == pytest.approx(0.1) and a + b > 1e5
    a, b = quality.prior(apart, "k")
    assert a / (a + b) == pytest.approx(0.5) and a + b < 1
    assert sum(quality.prior(same.limit(0), "k")) == 10


def test_quality_of_nothing(empty):
    assert quality.quality(empty).collect() == []


def test_ranks_without_gaps(spark):
    df = spark.createDataFrame([(i % 3, i % 11) for i in range(500)], "k long, v long")
    for buckets in (1, 7, 100):
        rows = common.bucket_ranks(df, ["k"], [F.col("v")], F.col("v"), buckets, "r").collect()
        by = brute.groups(rows, lambda r: r.k)
        assert all(sorted(r.r for r in g) == list(range(len(g))) for g in by.values()) and len(rows) == 500


def test_quotas_keep_places():
    rng = random.Random(1)
    for _ in range(200):
        held = [rng.randint(0, 20) for _ in range(5)]
        places = [h + rng.choice([0, 0, 3]) for h in held]
        wanted = {(s, t): rng.randint(1, 9) for s in range(5) for t in range(5) if s != t and rng.random() < 0.4}
        grant = sharding.quotas(wanted, held, places)
        assert all(0 < n <= wanted[k] for k, n in grant.items())
        after = [h + sum(n for (_, t), n in grant.items() if t == x) - sum(n for (s, _), n in grant.items() if s == x)
                 for x, h in enumerate(held)]
        assert all(a <= p for a, p in zip(after, places))


@pytest.mark.parametrize("kind", ["mixed", "all linked", "one group", "fewer than shards"])
def test_shards(spark, kind):
    rng = random.Random(3)
    texts = {
        "mixed": [f"t{rng.randrange(60)}" for _ in range(200)] + [f"single {i}" for i in range(203)] + [None, None, ""],
        "all linked": [f"t{i % 40}" for i in range(333)], "one group": ["same"] * 150 + [f"s{i}" for i in range(310)],
        "fewer than shards": ["a", "a", "b", None, "é"],
    }[kind]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = sharding.shard(df).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    n = Counter(r.shard for r in rows)
    assert set(n) <= set(range(16)) and max(n.values()) - min(n[s] for s in range(16)) <= 1
    for some in brute.groups(rows, lambda r: r.shard).values():
        assert sorted(r.slot for r in some) == list(range(len(some)))
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    placed = spark.createDataFrame([(texts[r.doc_id], r.shard) for r in rows if texts[r.doc_id]], "g string, shard int")
    cut = sharding.cut_edges(placed, "g").first()
    if kind == "mixed":
        assert cut["cut"] <= 0.05 * cut["pairs"]
    if kind == "one group":
        assert cut["cut"] <= 0.83 * cut["pairs"]  # 150 members, shards of 29: at best 5 full ones and 5 more
    if kind == "all linked":
        assert cut["cut"] <= 0.8 * cut["pairs"]


def cut_of(sizes, whole, cut, places):
    """(pairs cut, members by shard) of a plan, each member placed once."""
    held, lost, seen = Counter(), 0, Counter()
    for size, first, end, s in whole:
        held[s] += size * (end - first)
        seen[size] += end - first
    for (size, _), parts in brute.groups(cut, lambda c: c[:2]).items():
        parts.sort(key=lambda c: c[2])
        assert [c[2] for c in parts] == [0, *(c[3] for c in parts[:-1])] and parts[-1][3] == size
        for _, _, a, b, s in parts:
            held[s] += b - a
        lost += (size * size - sum((b - a) ** 2 for _, _, a, b, _ in parts)) // 2
        seen[size] += 1
    assert seen == Counter(sizes) and all(held[s] <= p for s, p in enumerate(places))
    return lost


def least_cut(groups, places):
    """The least pairs cut by any placement, by trying all."""
    if not groups:
        return 0
    size, best = groups[0], None
    for own in product(range(size + 1), repeat=len(places)):
        if sum(own) == size and all(n <= p for n, p in zip(own, places)):
            rest = least_cut(groups[1:], [p - n for n, p in zip(own, places)])
            if rest is not None:
                lost = (size * size - sum(n * n for n in own)) // 2 + rest
                best = lost if best is None else min(best, lost)
    return best


def test_start_is_near_the_least_cut():
    rng = random.Random(6)
    total = least = 0
    for _ in range(60):
        groups = [rng.randint(2, 5) for _ in range(rng.randint(1, 4))]
        rest = rng.randint(0, 4)
        rows = sum(groups) + rest
        places = [rows // 3 + (s < rows % 3) for s in range(3)]
        sizes = dict(Counter(groups))
        total += cut_of(sizes, *sharding.plan(sizes, places), places)
        least += least_cut(sorted(groups, reverse=True), places)
    assert least > 0 and total <= 1.1 * least


def test_groups_that_fit_are_hardly_cut(spark):
    """1,000 groups of eight in 16 shards of 500, and one group of 1,200 in shards of 829."""
    cases = [([f"t{i % 1000}" for i in range(8000)], 0.01), (["same"] * 1200 + [f"s{i}" for i in range(12064)], 0.43)]
    for texts, share in cases:
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        rows = sharding.shard(df).collect()
        n = Counter(r.shard for r in rows)
        assert len(rows) == len(texts) and max(n.values()) - min(n.values()) <= 1
        cells = Counter((texts[r.doc_id], r.shard) for r in rows)
        pairs = sum(c * (c - 1) // 2 for c in Counter(texts).values())
        assert 1 - sum(c * (c - 1) // 2 for c in cells.values()) / pairs <= share


def by_group(linked):
    return {g: Counter(r.shard for r in some) for g, some in brute.groups(linked.collect(), lambda r: r.grp).items()}


@pytest.mark.parametrize("kind", ["all linked", "many sizes", "larger than shards", "first shard full"])
def test_rounds_gather_what_the_start_deals(spark, kind):
    """No shard above its places, no more pairs cut than by the plan, groups where most of their members start."""
    rng = random.Random(8)
    grps = {
        "all linked": [f"g{i % 200}" for i in range(1600)],
        "many sizes": [f"g{min(int(rng.paretovariate(0.7)), 150)}" for _ in range(1500)] + [f"s{i}" for i in range(700)],
        "larger than shards": ["a"] * 300 + ["b"] * 170 + ["c", "d", "e"] * 20 + [f"s{i}" for i in range(400)],
        "first shard full": [f"g{i // 6}" for i in range(600)] + [f"g{i // 2}" for i in range(600)] + [f"s{i}" for i in range(400)],
    }[kind]
    if kind != "first shard full":
        rng.shuffle(grps)
    sizes = {g: n for g, n in Counter(grps).items() if n > 1}
    df = spark.createDataFrame([(g,) for g in grps], "grp string").coalesce(1).withColumn("row", F.monotonically_increasing_id())
    dealt = common.staged(sharding.start(df, 16).filter(F.col("grp").isin(list(sizes))).select("row", "grp", "shard"), "test")
    places = [len(grps) // 16 + (s < len(grps) % 16) for s in range(16)]
    groups = common.staged(spark.createDataFrame(list(sizes.items()), "grp string, n long"), "test")
    before = by_group(dealt)
    runs = [int(r.row) * 16 // len(grps) == r.shard for r in dealt.collect()]
    assert all(runs) and len(runs) == sum(sizes.values())
    linked = sharding.propagate(dealt, groups, places, 3)
    assert sorted(r.row for r in linked.collect()) == sorted(r.row for r in dealt.collect())
    after, held = by_group(linked), Counter()
    for c in after.values():
        held.update(c)
    assert {g: sum(c.values()) for g, c in after.items()} == sizes and all(held[s] <= p for s, p in enumerate(places))
    lost = sum((sizes[g] ** 2 - sum(n * n for n in c.values())) // 2 for g, c in after.items())
    counts = dict(Counter(sizes.values()))
    assert lost == cut_of(counts, *sharding.plan(counts, places), places)
    assert sum((sizes[g] ** 2 - sum(n * n for n in c.values())) // 2 for g, c in before.items()) > lost
    there = sum(n for g, c in after.items() for s, n in c.items() if len(c) == 1 and before[g][s] == max(before[g].values()))
    assert kind not in ("all linked", "first shard full") or there > 0.5 * sum(sizes.values())


def test_copies_gather_where_most_of_them_lie(spark):
    """Forty groups of nine in sixteen shards of fifty: five or more of each lie in one run of rows, the others far off."""
    texts = [f"s{i}" for i in range(800)]
    for g in range(40):
        at = [g % 16 * 50 + g // 16 * 9 + i for i in range(6)] + [(g + 5 + k) % 16 * 50 + 40 + g // 16 * 3 + k for k in range(3)]
        for i in at:
            texts[i] = f"g{g}"
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = sharding.shard(df).collect()
    assert set(Counter(r.shard for r in rows).values()) == {50}
    homes = {f"g{g}": Counter(i // 50 for i, t in enumerate(texts) if t == f"g{g}").most_common(1)[0] for g in range(40)}
    assert all(n >= 5 for _, n in homes.values())
    placed = brute.groups([r for r in rows if texts[r.doc_id] in homes], lambda r: texts[r.doc_id])
    assert all(len({r.shard for r in some}) == 1 for some in placed.values())
    assert sum(some[0].shard == homes[g][0] for g, some in placed.items()) >= 20


def test_shards_of_nothing(empty):
    assert sharding.shard(empty).collect() == []


ODD = ["1", "2", "0", "4", "9", "25", "255", "256", " ", "-", ".", "(", ")", "+", "@", "a", "b", "_", "é", "😀", "x.y", "com",
       " at ", "(at)", "4111111111111111", "+1 (988) 555-2485", "10.0.0.1", "\n"]


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(1500)] + [
        None, "", "a@b.c_d@e.f", "a@b@c.d", "1.2.3.4.5.6.7.8", "0001.002.255.0256", "1" * 20000, "1 " * 5000, "a.b@" * 3000,
        "a@" + "b." * 4000 + "c", "+1" + "2" * 9000 + " ", "." * 9000, "x 00.00.00.00 y", "4111 1111 1111 1111", "+12 (345) 678-90."]


def test_base_spans(spark, odd):
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pii.find(df, model=pii.Model([], [], {})).collect()}
    for i, t in enumerate(odd):
        want = brute.personal(t)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, k, _ in want) for x in range(4)), t[:80]
        assert r.spans == brute.named(want) and r.base_sha256 == brute.sha(brute.named(want))


@pytest.fixture(scope="module")
def private(spark):
    """Texts with personal data, some written so that the patterns miss it, and numbers that are none."""
    rng = random.Random(9)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(1200):
        three = [
            f"mail {rng.choice('abc')}{digits(2)}@host{digits(1)}.example.com", f"call +1 ({digits(3)}) 555-{digits(4)}",
            f"host 10.{rng.randrange(255)}.{rng.randrange(255)}.{rng.randrange(255)}", f"order {digits(7)}", f"lot {digits(11)}x",
        ]
        rows.append((i, f"some words {rng.choice(three)} and more words"))
    hard = [(5000 + i, f"some words call 1 ({digits(3)}) 555-{digits(4)} and more words") for i in range(30)]
    return spark.createDataFrame(rows + hard, "doc_id long, text string").repartition(4)


def test_trees_add_spans_and_leave_the_rest(private):
    model = pii.fit(private.select("text"))
    assert model.trees and model.thresholds
    rows = {r.doc_id: (r, t) for r, t in (
        (r, r.row.text) for r in pii.find(private, model=model, keep=("text",)).collect())}
    added = {d: set(map(tuple, r.all_spans)) - set(brute.personal(t)) for d, (r, t) in rows.items()}
    assert all(set(brute.personal(t)) <= set(map(tuple, r.all_spans)) for r, t in rows.values())
    assert not any(added[d] for d, (_, t) in rows.items() if "order" in t)
    again = {r.doc_id: r.spans for r in pii.find(private).collect()}
    assert again == {d: r.spans for d, (r, _) in rows.items()}


def test_the_main_path_has_no_python(private):
    plan = pii.find(private, model=pii.fit(private.select("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("Physical Plan")[1].replace("RoundRobin", "") or "Exchange RoundRobin" in plan


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é a@b.cd x"), (2, "no"), (3, "10.0.0.1"), (4, None)], "doc_id long, text string")
    rows = pii.find(df, model=pii.Model([], [], {}), keep=("text",))
    got = {r.doc_id: r.t for r in rows.select("doc_id", pii.redacted(F.col("row.text"), F.col("all_spans")).alias("t")).collect()}
    assert got == {1: "é <EMAIL> x", 2: "no", 3: "<IP>", 4: None}


def test_overlapping_spans_are_redacted_once(spark):
    df = spark.sql("select 'abcdefghij' as t, array(named_struct('start', 1, 'kind', 0, 'end', 4), "
                   "named_struct('start', 3, 'kind', 2, 'end', 6), named_struct('start', 8, 'kind', 3, 'end', 9)) as s")
    assert df.select(pii.redacted(F.col("t"), F.col("s"))).first()[0] == "a<EMAIL>gh<PHONE>j"


def test_personal_data_of_nothing_and_of_one_label(empty, spark):
    assert pii.find(empty).collect() == []
    df = spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")
    assert pii.find(df).first()["spans"] == "email:0:6"


def plain_top(rows, k, is_query):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in {i: min(v for j, v in ok if j == i) for i, _ in ok if is_query(i)}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("sizes", [(8192, 4096, 64), (40, 5, 8), (1, 1, 1)])
def test_top_k(spark, sizes):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] * 0.2 + rng.normal(size=8) * 0.05)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]
    rows += [(500, None), (510, [None] * 8), (520, [float("nan")] * 8), (530, [float("inf")] * 8), (540, [1.0, 2.0]),
             (550, [1.0, 3.0]), (560, []), (10, rows[10][1]), (None, rows[0][1]), (570, [0.1] * 8)]
    if sizes == (1, 1, 1):
        rows = rows[:12]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5, range_rows=sizes[0], query_rows=sizes[1], block=sizes[2]).collect()
    want = plain_top([(i, v) for i, v in rows], 5, lambda i: i % 10 == 0)
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == want


def test_pruning_scores_fewer_blocks():
    rng = np.random.default_rng(0)
    centres = rng.integers(-200, 200, (40, 16))
    x = np.concatenate([c + rng.integers(-3, 4, (100, 16)) for c in centres])
    ids = np.arange(len(x))
    *_, scored = topk.search_range(ids, x, ids[::50], x[::50], np.full(80, topk.NOTHING), 5)
    assert scored < 0.35 * 80 * len(x) / topk.BLOCK


def test_wide_numbers_stay_exact():
    x = np.array([[2**30, 1], [2**30, 2], [1, 1]])
    rows, ids, score, _ = topk.search_range(np.arange(3), x, np.array([9]), x[:1], np.array([topk.NOTHING]), 3)
    assert sorted(zip(ids.tolist(), score.tolist())) == [(0, 2**60 + 1), (1, 2**60 + 2), (2, 2**30 + 1)]


def test_rounds_of_ranges_give_the_same(spark, monkeypatch):
    """Hundreds of ranges, ties across them, and further columns of clashing names."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist(), 1.5, "x") for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double, rng string").repartition(3)
    want = plain_top([(i, v) for i, v, *_ in rows], 5, lambda i: i % 50 == 0)
    for growth in (2, 16):
        monkeypatch.setattr(topk, "GROWTH", growth)
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, 5, range_rows=10, query_rows=5, block=4).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 10 == 0).collect() == []


def test_passing_rows_are_those_that_quality_keeps(spark, frame, empty):
    rng = random.Random(2)
    rows = [(i % 50, prose(rng, 4 if i % 6 == 0 or 300 < i < 330 else 30), None if i % 11 == 0 else f"h{i // 30}", i) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, host int")
    for df in (docs, frame, empty):
        kept = quality.quality(df, keep=tuple(df.columns)).filter("kept").select("row.*")
        got = quality.passing_rows(df)
        assert got.columns == df.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, kept.collect()))
    assert 0 < quality.passing_rows(docs).count() < 400
