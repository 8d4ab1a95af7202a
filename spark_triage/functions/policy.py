"""Draft checks and the escalation decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv
from spark_triage.functions import text as tx

_FLAGS = "array<struct<kind:string,detail:string,score:double>>"


def validate_draft(
    reply: Column,
    top1_reply: Column | None = None,
    allowlist: Sequence[str] = fv.NAME_ALLOWLIST,
    near_verbatim: float = fv.NEAR_VERBATIM_THRESHOLD,
    brand: str | None = None,
    greetings: Sequence[str] = fv.GREETINGS,
) -> Column:
    """Flags of a drafted reply as ``array<struct<kind, detail, score>>``, empty when clean.

    ``top1_reply`` is the best retrieved reply, cleaned here; leave it out (or NULL) when nothing was
    retrieved. ``brand`` is the handle that may stand in a reply like an allowed name.
    """
    null_score = F.lit(None).cast("double")

    def flag(kind: str, detail: Column, score: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), detail.alias("detail"), score.alias("score"))

    signatures = F.transform(
        F.regexp_extract_all(reply, F.lit("(?U)" + fv.SIGNATURE_PATTERN), F.lit(0)),
        lambda s: flag("signature", s, null_score),
    )
    names = F.transform(tx.name_leaks(reply, allowlist, greetings, brand), lambda n: flag("name", n, null_score))
    parts = [F.coalesce(signatures.cast(_FLAGS), F.array().cast(_FLAGS)),
             F.coalesce(names.cast(_FLAGS), F.array().cast(_FLAGS))]
    if top1_reply is not None:
        share = tx.token_overlap(reply, tx.clean_reply(top1_reply))
        copied = F.when(
            F.coalesce(share >= near_verbatim, F.lit(False)) & top1_reply.isNotNull(),
            F.array(flag("near_verbatim", F.concat(F.bround(share * 100, 0).cast("int"), F.lit("%")), share)),
        ).cast(_FLAGS)
        parts.append(F.coalesce(copied, F.array().cast(_FLAGS)))
    return F.concat(*parts)


def flag_message(flag: Column) -> Column:
    kind, detail = flag["kind"], flag["detail"]
    return (
        F.when(kind == "signature", F.concat(F.lit("leftover agent signature '"), detail, F.lit("'")))
        .when(kind == "name",
              F.concat(F.lit("name used in draft: '"), detail, F.lit("' (names are banned by policy)")))
        .otherwise(F.concat(F.lit("near-verbatim: "), detail, F.lit(" token overlap with top-1 retrieved reply")))
    )


def flag_list_text(flags: Column) -> Column:
    """The flag messages as one bracketed, quoted list."""

    def quoted(flag: Column) -> Column:
        message = flag_message(flag)
        quote = F.when(F.instr(message, "'") > 0, F.lit('"')).otherwise(F.lit("'"))
        return F.concat(quote, message, quote)

    return F.concat(F.lit("["), F.array_join(F.transform(flags, quoted), ", "), F.lit("]"))


def decide(
    intent: Column,
    confidence: Column,
    override: Column,
    similarity: Column,
    flags: Column,
    high_risk: Sequence[str] = fv.HIGH_RISK_INTENTS,
    min_confidence: float = fv.CONFIDENCE_THRESHOLD,
    min_similarity: float = fv.SIMILARITY_THRESHOLD,
) -> Column:
    """STRUCT<decision, reason>: override, then high risk, then flags, then the two score floors."""
    similarity = F.coalesce(similarity, F.lit(0.0))
    conf2 = F.when(confidence.isNull(), F.lit("missing")).otherwise(F.format_string("%.2f", confidence))
    sim2 = F.format_string("%.2f", similarity)
    # A missing confidence is a low one: nothing is handled automatically for want of a value.
    low_conf, low_sim = F.coalesce(confidence < min_confidence, F.lit(True)), similarity < min_similarity
    failed = F.concat_ws(
        "; ",
        F.when(low_conf, F.concat(F.lit("confidence "), conf2, F.lit(f" < {min_confidence}"))),
        F.when(low_sim, F.concat(F.lit("retrieval_top1_similarity "), sim2, F.lit(f" < {min_similarity}"))),
    )
    override = F.coalesce(override, F.lit(False))
    risky = F.coalesce(intent.isin(*high_risk), F.lit(False))
    flagged = F.coalesce(F.size(flags), F.lit(0)) > 0
    escalate = override | risky | flagged | low_conf | low_sim
    reason = (
        F.when(override, F.lit("security/fraud keyword match"))
        .when(risky, F.concat(F.lit("high-risk intent '"), intent,
                              F.lit("': requires human for account/money/trust action, regardless of confidence")))
        .when(flagged, F.concat(F.lit("generated reply failed automated safety validation: "),
                                flag_list_text(flags)))
        .when(low_conf | low_sim, failed)
        .otherwise(F.concat(F.lit("confidence "), conf2, F.lit(f" >= {min_confidence} and similarity "),
                            sim2, F.lit(f" >= {min_similarity}")))
    )
    return F.struct(
        F.when(escalate, F.lit("escalate")).otherwise(F.lit("auto")).alias("decision"),
        reason.alias("reason"),
    )


def decide_by_intent(intent: Column, high_risk: Sequence[str] = fv.HIGH_RISK_INTENTS) -> Column:
    """The reduced policy: only the high-risk rule."""
    return F.when(intent.isin(*high_risk), F.lit("escalate")).otherwise(F.lit("auto"))
