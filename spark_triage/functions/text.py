"""Text column functions. Each takes and returns Columns and runs inside generated code."""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from spark_triage import fixed_values as fv

# Character classes written out so that every regex engine agrees on them.
SPACE = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"

EMAIL_CHARS = rf"{WORD}.+\-"
# An address can only start where a run of its characters starts, or right after the last match; saying
# so, and taking the run possessively, keeps long unbroken lines linear.
EMAIL = rf"(?:(?<![{EMAIL_CHARS}])|\G)[{EMAIL_CHARS}]++@[{WORD}\-]+\.[{WORD}.\-]+"
PHONE = rf"(?<!{DIGIT})\+?{DIGIT}[{DIGIT}\-.{SPACE}]{{7,}}{DIGIT}(?!{DIGIT})"
URL = rf"https?://[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"


# ---- HTML entities ------------------------------------------------------------------------------

# Windows-1252 meaning of the C1 numeric references, as HTML5 requires; undefined bytes stay themselves.
_C1 = {str(b): (bytes([b]).decode("cp1252", "ignore") or chr(b)) for b in range(0x80, 0xA0)}
_LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_ENTITY_HEAD = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _literal_map(table: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _code_point(code: Column) -> Column:
    """The character of a numeric reference; invalid ones follow the HTML5 rules."""
    dropped = (
        code.between(1, 8) | (code == 0x0B) | code.between(0x0E, 0x1F) | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    return (
        F.when(code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF),
               F.lit("\ufffd"))
        .when(code.between(0x80, 0x9F), F.element_at(_literal_map(_C1), code.cast("string")))
        .when(dropped, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _decode_piece(piece: Column) -> Column:
    """What stands after one ampersand, with its entity (if any) replaced."""
    head = F.regexp_extract(piece, _ENTITY_HEAD, 1)
    decimal = F.regexp_extract(head, "^#0*([0-9]+)", 1)
    hexa = F.regexp_extract(head, "^#[xX]0*([0-9a-fA-F]+)", 1)
    legacy = F.regexp_extract(head, "^(" + "|".join(_LEGACY) + ")", 1)

    def after(part: Column) -> Column:
        return F.substring(piece, F.length(part) + 1, F.length(piece))

    return F.coalesce(
        F.when(decimal != "", F.concat(
            _code_point(F.when(F.length(decimal) <= 9, decimal.try_cast("bigint"))), after(head))),
        F.when(hexa != "", F.concat(
            _code_point(F.when(F.length(hexa) <= 8, F.conv(hexa, 16, 10).try_cast("bigint"))), after(head))),
        F.concat(F.element_at(_literal_map(html5), head), after(head)),
        F.when(legacy != "", F.concat(
            F.element_at(_literal_map({n: html5[n] for n in _LEGACY}), legacy), after(legacy))),
        F.concat(F.lit("&"), piece),
    )


def unescape_html(text: Column) -> Column:
    """Replace named and numeric HTML entities, once (``&amp;lt;`` becomes ``&lt;``)."""
    pieces = F.split(text, "&")
    decoded = F.concat(
        F.element_at(pieces, 1),
        F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), _decode_piece), ""),
    )
    return F.when(F.instr(text, "&") > 0, decoded).otherwise(text)


# ---- cleaning -----------------------------------------------------------------------------------


def redact_pii(text: Column) -> Column:
    """E-mail addresses first, then phone-like digit runs."""
    text = F.regexp_replace(text, EMAIL, fv.EMAIL_PLACEHOLDER)
    return F.regexp_replace(text, PHONE, fv.PHONE_PLACEHOLDER)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def clean_text(text: Column) -> Column:
    """Unescape, redact, replace URLs, drop mentions, squeeze whitespace. The order is part of the result."""
    text = redact_pii(unescape_html(text))
    text = F.regexp_replace(text, URL, fv.URL_PLACEHOLDER)
    text = F.regexp_replace(text, MENTION, "")
    return squeeze(text)


def clean_reply(text: Column) -> Column:
    """A retrieved reply without agent signatures."""
    return squeeze(F.regexp_replace(text, "(?U)" + fv.SIGNATURE_PATTERN, ""))


# ---- predicates -----------------------------------------------------------------------------------


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """True when any pattern is found, ignoring case; NULL text counts as no match."""
    return F.coalesce(F.rlike(text, F.lit("(?iUd)" + "|".join(patterns))), F.lit(False))


def matched_patterns(text: Column, patterns: Sequence[str]) -> Column:
    """The patterns that fired, in list order."""
    return F.array_compact(F.array(*[F.when(matches_any(text, [p]), F.lit(p)) for p in patterns]))


def deflection_flag(text: Column, patterns: Sequence[str] = fv.DEFLECTION_PATTERNS) -> Column:
    return matches_any(text, patterns)


def has_link(raw_reply: Column, pattern: str = fv.SHORT_LINK_PATTERN) -> Column:
    """Short link in the raw reply, looked for before any cleaning."""
    return matches_any(raw_reply, [pattern])


def fraud_override(text: Column, patterns: Sequence[str] = fv.FRAUD_PATTERNS) -> Column:
    return matches_any(text, patterns)


def vocab_overlap(text: Column, patterns: Sequence[str] = fv.PAY_FOR_PATTERNS) -> Column:
    return matches_any(text, patterns)


def is_substantive(link: Column, reply_clean: Column, min_length: int = fv.MIN_REPLY_LENGTH) -> Column:
    return ~link & (F.length(reply_clean) >= min_length)


# ---- tokens and names ------------------------------------------------------------------------------


def token_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9']+"), F.lit(0)))


def overlap_coefficient(left: Column, right: Column) -> Column:
    """Shared tokens over the smaller token set; 0 when either set is empty."""
    smaller = F.least(F.size(left), F.size(right))
    return F.when(smaller <= 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(left, right)).cast("double") / smaller
    )


def token_overlap(left: Column, right: Column) -> Column:
    return overlap_coefficient(token_set(left), token_set(right))


def name_leaks(
    text: Column, allowlist: Sequence[str] = fv.NAME_ALLOWLIST, greetings: Sequence[str] = fv.GREETINGS,
    brand: str | None = None,
) -> Column:
    """Sorted distinct capitalised words after a greeting, or before ``,``/``!`` inside a sentence, without the
    allowed ones and the ``brand``'s own handle."""
    flat = F.regexp_replace(text, rf"[{SPACE}]+", " ")
    greeted = F.regexp_extract_all(
        flat, F.lit(rf"(?U)\b(?:{'|'.join(greetings)})\b,? ([A-Z][a-zA-Z]+)"), F.lit(1)
    )
    inside = F.regexp_extract_all(
        flat, F.lit(r"""(?U)(?:(?<=[^.!?"' ] )|(?<=[^.!?"' ]))\b([A-Z][a-zA-Z]+)[,!]"""), F.lit(1)
    )
    allowed = F.array(*[F.lit(w) for w in (*allowlist, *([brand] if brand else []))]).cast("array<string>")
    return F.array_sort(F.array_except(F.array_union(greeted, inside), allowed))
