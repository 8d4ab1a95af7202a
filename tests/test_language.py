from collections import Counter
from math import log

from pyspark.sql import functions as F

from spark_triage.operators import language as lg

TRAIN = [(1, "the cat and the dog are in the house", "en"), (2, "der hund und die katze sind im haus", "de"),
         (3, "where is the order that was sent", "en"), (4, "wo ist die bestellung die ich habe", "de")]
TEXTS = [(1, "the dog is in the house"), (2, "die katze ist im haus"), (3, "12345 !!"), (4, ""), (5, "日本語"), (6, "THE"),
         (7, "été 😀 und"), (8, None)]


def grams(text):
    words = "".join(ch if ch.isalpha() else " " for ch in (text or "").lower()).split()
    padded = f" {' '.join(words)} "
    return [padded[i:i + 3] for i in range(len(padded) - 2)] if words else []


def expected():
    top = {}
    for lang in ("de", "en"):
        counts = Counter(g for _, t, x in TRAIN if x == lang for g in grams(t))
        top[lang] = counts
    vocab = len(set(top["de"]) | set(top["en"]))
    out = {}
    for i, text in TEXTS:
        seen = grams(text)
        if not any(g in top["de"] or g in top["en"] for g in seen):
            out[i] = None
            continue
        score = {x: sum(log((top[x].get(g, 0) + 1) / (sum(top[x].values()) + vocab)) for g in seen) for x in top}
        out[i] = max(sorted(score), key=score.get)
    return out


def test_detection_matches_brute_force(spark):
    train = spark.createDataFrame(TRAIN, "id int, text string, lang string")
    profile = lg.language_profile(train, "text", "lang", ["de", "en"])
    assert {r.gram for r in profile.collect()} == {g for _, t, _ in TRAIN for g in grams(t)}
    found = lg.detect_language(spark.createDataFrame(TEXTS, "id int, text string"), "text", profile, ["de", "en"])
    assert {r.id: r.detected for r in found.collect()} == expected()
    kept = lg.language_filter(found, language="en")
    assert {r.id for r in kept.collect()} == {i for i, x in expected().items() if x == "en"}


def test_rows_that_share_an_id_are_scored_apart(spark):
    train = spark.createDataFrame(TRAIN, "id int, text string, lang string")
    profile = lg.language_profile(train, "text", "lang", ["de", "en"])
    df = spark.createDataFrame([(1, "the dog is in the house"), (1, "die katze ist im haus")], "id int, text string")
    assert sorted(r.detected for r in lg.detect_language(df, "text", profile, ["de", "en"]).collect()) == ["de", "en"]


def test_a_profile_of_nothing_detects_nothing(spark):
    train = spark.createDataFrame([], "text string, lang string")
    profile = lg.language_profile(train, "text", "lang", ["de", "en"])
    df = spark.createDataFrame([("the dog",)], "text string")
    assert lg.detect_language(df, "text", profile, ["de", "en"]).first().detected is None


def test_trigrams_of_supplementary_letters(spark):
    row = spark.createDataFrame([("a𝒳b",)], "t string").select(lg.trigrams(F.col("t")).alias("g")).first()
    assert row.g == [" a𝒳", "a𝒳b", "𝒳b "]


def test_blocks_of_few_bytes_give_the_same(spark, monkeypatch):
    """Many blocks, texts longer than a stretch, repeated rows and further columns of any kind."""
    import random

    rng = random.Random(1)
    words = {"en": "the cat and dog are in house where order was sent".split(), "de": "der hund und die katze sind im haus wo bestellung".split()}
    rows = [(i % 40, " ".join(rng.choice(words[x]) for _ in range(rng.choice([1, 5, 400]))), x, [i], {"k": i}) for i in range(200) for x in ("en", "de")]
    df = spark.createDataFrame(rows, "id int, text string, lang string, detected array<int>, m map<string,int>").repartition(5)
    profile = lg.language_profile(df, "text", "lang", ["de", "en"])
    plain = sorted((r.id, r.text, r.lang, r.found) for r in lg.detect_language(df, "text", profile, ["de", "en"], "found").collect())
    monkeypatch.setattr(lg, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lg, "STRETCH", 64)
    small = lg.detect_language(df, "text", profile, ["de", "en"], "found")
    assert small.columns == [*df.columns, "found"]
    assert sorted((r.id, r.text, r.lang, r.found) for r in small.collect()) == plain
    assert sum(r[2] == r[3] for r in plain) > 0.9 * len(plain)
    replaced = lg.detect_language(df, "text", profile, ["de", "en"])
    assert replaced.schema["detected"].dataType.simpleString() == "string" and replaced.count() == len(rows)


def test_letters_are_those_of_the_expressions(spark):
    letter = lg._letter_points(spark)
    assert [letter[ord(c)] for c in "aZé日𝒳_1 -̇"] == [True] * 5 + [False] * 5


def test_a_small_profile_goes_to_the_tasks_and_a_large_one_does_not(spark, monkeypatch):
    """Texts that begin and end in the middle of words, without letters, NULL, and in many scripts."""
    train = spark.createDataFrame(TRAIN, "id int, text string, lang string")
    texts = [t for _, t in TEXTS] + ["haus", "order", "...", "die", None, "x", "日本 der 語", "İm haus", "the", " und ", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    profile = lg.language_profile(train, "text", "lang", ["de", "en"])
    by_blocks, blocks = {}, lg._blocks
    made = []
    monkeypatch.setattr(lg, "_blocks", lambda *a: (made.append(1), blocks(*a))[1])
    sent = {r.id: r.detected for r in lg.detect_language(df, "text", profile, ["de", "en"]).collect()}
    assert not made
    by_blocks = {r.id: r.detected for r in lg.detect_language(df, "text", profile, ["de", "en"], sent_grams=3).collect()}
    assert made and sent == by_blocks and len(sent) == len(texts)
    seen = lg.language_profile(df.withColumn("lang", F.lit("de")), "text", "lang", ["de", "en"])
    want = df.select(F.explode(lg.trigrams(F.col("text"))).alias("gram")).groupBy("gram").count().collect()
    assert {r.gram: round(2.718281828459045 ** r.w_de - 1) for r in seen.collect()} == {r.gram: r["count"] for r in want}
