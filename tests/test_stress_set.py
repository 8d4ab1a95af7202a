import hashlib
import random

import pytest

from spark_triage.operators import stress_set as ss


def key(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i


def brute_force(rows, plan):
    groups = {}
    for r in rows:
        groups.setdefault(r["intent"], []).append(r["id"])
    base, rem = divmod(plan.stratified, len(groups))
    strat = {i for n, g in enumerate(sorted(groups))
             for i in sorted(groups[g], key=lambda i: key(plan.stratify_seed, i))[: base + (n < rem)]}
    rest = [r for r in rows if r["id"] not in strat]
    by_sim = sorted(rest, key=lambda r: (r["max_similarity"], r["id"]))
    taken = {}

    def take(pool, label, n):
        free = sorted((r["id"] for r in pool if r["id"] not in taken), key=lambda i: key(plan.hard_seed, i))
        taken.update({i: label for i in free[:n]})

    n = plan.per_category
    take([r for r in rest if r["fraud_override"]], "fraud_keyword", n)
    take([r for r in rest if r["max_similarity"] > plan.high_similarity], "near_verbatim_stress", n)
    take([r for r in rest if r["pay_for_match"]], "pay_for_vocab_overlap", n)
    take(by_sim[: plan.low_pool], "low_retrieval_similarity", n)
    short = plan.hard_total - len(taken)
    if short > 0:
        take(by_sim[: plan.low_pool + short], "low_retrieval_similarity_backfill", short)
    return {**{i: "" for i in strat}, **taken}


@pytest.mark.parametrize("seed, plan", [
    (1, ss.StressPlan()),
    (2, ss.StressPlan(stratified=30, per_category=10, hard_total=40, low_pool=5)),
    (3, ss.StressPlan(stratified=20, per_category=4, hard_total=30, low_pool=12, high_similarity=0.3)),
])
def test_selection_matches_step_by_step_taking(spark, seed, plan):
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        hot = rng.random()
        rows.append({"id": i, "intent": rng.choice("aaabcd"), "fraud_override": hot < 0.1, "pay_for_match": hot < 0.12 or rng.random() < 0.02,
                     "max_similarity": round(rng.random(), 2) if seed != 2 else round(rng.random() * 0.9, 2)})
    df = spark.createDataFrame(rows, "id bigint, intent string, fraud_override boolean, pay_for_match boolean, max_similarity double")
    got = ss.select_stress_set(df, "id", "intent", plan).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.hard_case_category for r in got} == brute_force(rows, plan)
