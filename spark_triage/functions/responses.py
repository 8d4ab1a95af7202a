"""Reading model responses: lenient JSON, then validity per kind of response."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv


def _get(value: Column, path: str, dtype: str) -> Column:
    return F.try_variant_get(value, path, dtype)


def extract_json(raw: Column) -> Column:
    """The JSON object of a response as VARIANT, or NULL.

    The whole text counts when it is an object; otherwise the stretch from the first ``{`` to the last
    ``}`` is tried. Text that is valid JSON of another kind is not an object, so it gives NULL. The
    parser stops after the first value, so two wrappings are used to see that nothing follows it.
    """
    body = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    listed = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    nested = F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit("}")))
    strict = nested.isNotNull() & _get(listed, "$[1]", "variant").isNull()
    is_list = F.rlike(raw, F.lit(r"(?s)^\s*\[.*\]\s*$")) & F.try_parse_json(raw).isNotNull()
    return F.when((body != "") & strict & ~is_list, _get(listed, "$[0]", "variant"))


def parse_classification(raw: Column, intents: Sequence[str] = fv.INTENTS) -> Column:
    """STRUCT<intent, confidence, status>.

    status: ``ok``; ``retry`` when there is no object, the intent is unknown or confidence is missing;
    ``failed`` when confidence is present but is not a number (no second attempt helps the caller then).
    """
    parsed = extract_json(raw)
    intent = _get(parsed, "$.intent", "string")
    stated = _get(parsed, "$.confidence", "string")
    confidence = _get(parsed, "$.confidence", "double")
    known = F.coalesce(intent.isin(*intents), F.lit(False))
    status = (
        F.when(~known | stated.isNull(), F.lit("retry"))
        .when(confidence.isNull(), F.lit("failed"))
        .otherwise(F.lit("ok"))
    )
    return F.struct(
        F.when(status == "ok", intent).alias("intent"),
        F.when(status == "ok", confidence).alias("confidence"),
        status.alias("status"),
    )


def parse_judge(raw: Column, dimensions: Sequence[str] = fv.JUDGE_DIMENSIONS) -> Column:
    """STRUCT<valid, <dim>_score, <dim>_rationale, ...>; all five must be numeric 1..5 with a rationale."""
    parsed = extract_json(raw)
    fields, valid = [], F.lit(True)
    for d in dimensions:
        score = _get(parsed, f"$.{d}.score", "double")
        text_score = F.schema_of_variant(_get(parsed, f"$.{d}.score", "variant")) == "STRING"
        rationale = _get(parsed, f"$.{d}.rationale", "string")
        fine = score.between(1, 5) & ~text_score & (rationale != "")
        valid = valid & F.coalesce(fine, F.lit(False))
        fields += [(score, f"{d}_score"), (rationale, f"{d}_rationale")]
    return F.struct(valid.alias("valid"), *[F.when(valid, c).alias(n) for c, n in fields])
