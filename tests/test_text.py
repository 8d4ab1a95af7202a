import html

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import text as tx


@pytest.mark.parametrize("part", [
    "a &amp; b", "&amp;lt;", "&lt;b&gt; &quot;x&quot; &#39;y&#x27;", "&notit; &copy2024 &nosuch; & x &&",
    "&#128;&#8364;&#0;&#xD800;&#x1F600;&#1;&#129;&#x110000;&#99999999999;", "x&NotEqualTilde;y&ampfoo", "", "plain",
    "&", "&#;&#x;", "&#65 &#x41g &eacute;t&eacute;", "&#127;&#xFFFE;&#13;", "&#0000065;&#x000041;",
])
def test_unescape_known(apply, part):
    assert apply(tx.unescape_html, [part]) == [html.unescape(part)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="&#;xX0123456789ampltgtcopyé ", max_size=30), min_size=20, max_size=40))
def test_unescape_like_the_standard_library(apply, values):
    assert apply(tx.unescape_html, values) == [html.unescape(v) for v in values]


def test_clean_text_steps(apply):
    cases = {
        "a@b.c+d@e.f x": "<EMAIL><EMAIL> x",
        "@115850 hi @123456789012 there": "hi @<PHONE> there",
        "call +44 20 7946 0958 now": "call <PHONE> now",
        "user12345678@gmail.com": "<EMAIL>",
        "see https://t.co/abc é @été ok z": "see <URL> é ok z",
        "2024-01-02 10:11": "<PHONE>:11",
        "12345678 is short": "12345678 is short",
        "5+123456789": "5+<PHONE>",
        "１２３４５６７８９０": "<PHONE>",
        "Tom &amp; co": "Tom & co",
        "  \t spaced \n out ": "spaced out",
        "": "",
    }
    assert apply(tx.clean_text, list(cases)) == list(cases.values())
    assert apply(tx.clean_text, [None]) == [None]


def test_cleaning_leaves_no_pii_and_is_stable(apply):
    texts = ["x a@b.co 0123 456 789 0 y", "&#64;me a&#64;b.de", "mail me: q.w+e@z-y.org, 99.99.99.99.99"]
    once = apply(tx.clean_text, texts)
    assert apply(tx.redact_pii, once) == once


def test_long_unbroken_line_is_linear(apply):
    assert apply(tx.redact_pii, ["a" * 300_000]) == ["a" * 300_000]


def test_deflection_and_links(apply):
    texts = ["Please DM us", "8 PM", "see https://t.co/xY", "follow & dm", "nothing", None, "direct message", "your dm"]
    assert apply(tx.deflection_flag, texts) == [True, False, True, True, False, False, True, True]
    assert apply(tx.has_link, texts) == [False, False, True, False, False, False, False, False]


def test_override_patterns(apply):
    texts = ["I was SCAMMED", "this is a scamp", "suspicious looking email", "they stole my parcel", "fine",
             "my account is locked and it isn't me", "cc details", "unauthorised use", None]
    assert apply(tx.fraud_override, texts) == [True, False, True, True, False, True, True, True, False]
    fired = apply(lambda c: tx.matched_patterns(c, fv.FRAUD_PATTERNS), ["police, fraud!", "fine"])
    assert fired == [[r"\bfraud(ulent)?\b", r"\bpolice\b"], []]


def test_vocab_overlap(apply):
    assert apply(tx.vocab_overlap, ["I pay for it", "paid  for", "paying for", "pay", "prepaid forever"]) == [
        True, True, True, False, False]


def test_the_brand_handle_is_no_name(apply):
    text = ["Thanks for writing, AmazonHelp, we look into it", "Hi Bob, we are on it"]
    assert apply(lambda c: tx.name_leaks(c), text, ) == [["AmazonHelp"], ["Bob"]]
    assert apply(lambda c: tx.name_leaks(c, brand="AmazonHelp"), text) == [[], ["Bob"]]


def test_name_leaks(apply):
    texts = [
        "so sorry for the delay, Alex. Thanks, Bob! Hi Amazon, Eve! on Diwali, ok", "Hi Hello Bob", 'Dear, Ann (Zed, "Quo! x',
        "a  Tim! ^LR", "Bob, first", "he said. Sue, no", "éBob, no", "Prime, Kindle! ok",
    ]
    assert apply(tx.name_leaks, texts) == [
        ["Bob", "Diwali", "Eve"], ["Hello"], ["Ann", "Zed"], ["Tim"], [], [], [], []]


def test_clean_reply(apply):
    assert apply(tx.clean_reply, ["Hi  there ^LR", "x ^MNO y ^abc", "^AB"]) == ["Hi there", "x y ^abc", ""]


def test_token_overlap(spark):
    rows = spark.createDataFrame([("a b c", "b c d e"), ("", "a"), ("It's it's", "it's"), ("!!", "!!")], "a string, b string")
    got = [r[0] for r in rows.select(tx.token_overlap(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([2 / 3, 0.0, 1.0, 0.0])


def test_functions_accept_a_stream(spark, tmp_path):
    spark.createDataFrame([("x",)], "text string").write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    out = stream.select(tx.clean_text(F.col("text")), tx.fraud_override(F.col("text")), tx.name_leaks(F.col("text")))
    assert out.isStreaming
