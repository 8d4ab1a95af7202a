import random

import pytest

SYLLABLES = "the an er ti on re sh le ing ed".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with copies, near copies, shared passages, nulls, empty, odd and long texts."""
    rng = random.Random(11)
    docs = [prose(rng, rng.choice([3, 8, 40, 120, 300])) for _ in range(60)]
    passage = prose(rng, 60)
    for i in range(0, 40, 4):
        docs.append(prose(rng, 30) + " " + passage + "\n" + prose(rng, rng.randint(0, 30)))
    base = prose(rng, 200).split()
    for i in range(30):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        docs.append(" ".join(w))
    docs += [docs[0]] * 5 + [docs[1].upper(), "  " + docs[2].replace(" ", "\t\n") + " "]
    docs += [None, None, "", " \n\t ", "one", "ONE", "a b c d", "é ü 中文 😀 x", "same line\nsame line\nsame line\n\n",
             "word " * 5000, "x" * 70000, passage + " " + passage, "#$% & | <> **"]
    return list(enumerate(docs))


@pytest.fixture(scope="session")
def frame(spark, corpus):
    """The corpus with further columns, some of names that the operators use themselves."""
    rows = [(d, t, f"src{d % 3}" if d % 7 else None, "en", len(t or ""), 1, "k", 2.0) for d, t in corpus]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, n_chars long, shard int, kept_text string, row double"
    ).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")
