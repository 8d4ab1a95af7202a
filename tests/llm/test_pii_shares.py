"""Spans that the base patterns miss are found, be they few or many."""

import random

import pytest

from spark_triage.llm import pii


def planted(share, n=1500):
    """[(doc_id, text, hard span or None)]: base forms, numbers that are none, and ``share`` written otherwise."""
    rng = random.Random(31)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    out = []
    for i in range(n):
        hard = i < n * share
        if hard:
            word, span = rng.choice([
                ("call", f"{rng.randint(1, 9)} ({digits(3)}) 555-{digits(4)}"),
                ("mail", f"{rng.choice('abc')}{digits(3)} (at) host{digits(1)}.example.com"),
            ])
        else:
            word, span = rng.choice([
                ("mail", f"{rng.choice('abc')}{digits(3)}@host{digits(1)}.example.com"), ("call", f"+1 ({digits(3)}) 555-{digits(4)}"),
                ("order", digits(7)), ("order", digits(10)), ("lot", digits(11) + "x"), ("version", f"1.{digits(1)}.2.3.4.5"),
                ("date", f"20{rng.randint(10, 24)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"),
            ])
        out.append((i, f"some words {word} {span} and more words", span if hard else None))
    return out


@pytest.mark.parametrize("share", [0.01, 0.1, 0.5])
def test_hard_spans_are_found_at_any_share(spark, share):
    rows = planted(share)
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    got = {r.doc_id: [(s.start, s.end) for s in r.all_spans] for r in pii.find(df).collect()}
    missed = [t for i, t, span in rows if span and not any(a <= t.index(span) and b >= t.index(span) + len(span) for a, b in got[i])]
    wrong = [t for i, t, _ in rows if any(w in t for w in (" order ", " lot ", " date ")) and got[i]]
    assert not missed and not wrong, (missed[:5], wrong[:5])


def test_every_labelled_candidate_trains_or_is_held_out(spark, monkeypatch):
    """More rows of a kind and label than its even share: none is left out."""
    from pyspark.ml.classification import GBTClassifier

    texts = [f"some words order {10_000_000 + i} and +1 (555) 555-{1000 + i} more" for i in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    seen, fitted, rows = [], GBTClassifier.fit, pii.staged

    def fit(self, ready, *more):
        seen.append((ready.count(), self.getWeightCol()))
        return fitted(self, ready, *more)

    def staged(frame, name, *more):
        out = rows(frame, name, *more)
        if name == "pii-pool":
            seen.append(out.filter("pmod(h, 10) >= 3").count())
        return out

    monkeypatch.setattr(GBTClassifier, "fit", fit)
    monkeypatch.setattr(pii, "staged", staged)
    assert pii.fit(df).trees
    assert seen[0] > 2000 and seen[1] == (seen[0], "weight")
