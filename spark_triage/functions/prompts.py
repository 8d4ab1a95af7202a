"""Prompt columns. The model itself is the caller's; these only assemble its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions.text import clean_reply


def classify_instruction(brand: str, taxonomy: Sequence[tuple] = fv.TAXONOMY) -> str:
    rows = [
        f"- {intent} ({label}): {definition}" + "".join(f'\n    e.g. "{e}"' for e in examples)
        for intent, label, definition, examples in taxonomy
    ]
    return "\n".join([fv.CLASSIFY_HEAD.format(brand=brand), *rows, fv.CLASSIFY_TAIL])


def classify_prompt(text: Column, brand: str, taxonomy: Sequence[tuple] = fv.TAXONOMY) -> Column:
    return F.concat(
        F.lit(classify_instruction(brand, taxonomy) + '\n\nClassify this customer tweet:\n"'),
        text,
        F.lit('"\n\n' + fv.CLASSIFY_FORMAT),
    )


def draft_prompt(text: Column, examples: Column, brand: str, company: str) -> Column:
    """``examples``: array<struct<customer_tweet_clean, brand_reply_clean>> in rank order."""
    shown = F.transform(
        examples,
        lambda e: F.concat(
            F.lit('- Customer: "'), e["customer_tweet_clean"], F.lit(f'"\n  {brand}: "'),
            clean_reply(e["brand_reply_clean"]), F.lit('"'),
        ),
    )
    return F.concat_ws(
        "\n",
        F.lit(fv.DRAFT_INSTRUCTION.format(brand=brand, company=company)),
        F.lit(fv.DRAFT_EXAMPLES_HEAD.format(brand=brand)),
        shown,
        F.concat(F.lit(fv.DRAFT_TWEET_HEAD + '\n"'), text, F.lit('"')),
        F.lit(fv.DRAFT_TAIL),
    )


def judge_prompt(text: Column, reply: Column) -> Column:
    return F.concat(
        F.lit(fv.JUDGE_INSTRUCTION + '\n\nCUSTOMER TWEET: "'), text,
        F.lit('"\n\nAGENT REPLY: "'), reply,
        F.lit('"\n\n' + fv.JUDGE_FORMAT),
    )


def retry_prompt(prompt: Column, suffix: str = fv.CLASSIFY_RETRY) -> Column:
    return F.concat(prompt, F.lit(suffix))


def query_text(text: Column, prefix: str = fv.QUERY_PREFIX) -> Column:
    """Query-side prefix of asymmetric retrieval; the corpus side stays as it is."""
    return F.concat(F.lit(prefix), text)
