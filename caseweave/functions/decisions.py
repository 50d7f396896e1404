"""Rules, keyword compatibility, routing decisions and replies as column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from caseweave.functions import lexicon, text as tx

RuleTable = Sequence[tuple[str, bool, Sequence[str]]]


# Word edges as the rules mean them: between a letter, digit or underscore and anything else. Java's own edge counts
# combining marks, joiners and variation selectors as word characters, so a word beside an emoji would have none.
AHEAD, BEHIND = rf"(?![{tx.WORD}])", rf"(?<![{tx.WORD}])"
EDGE = rf"(?:{BEHIND}(?=[{tx.WORD}])|(?<=[{tx.WORD}]){AHEAD})"


def _first_letters(patterns: Sequence[str]) -> str:
    """A look ahead for the letters that the patterns begin with, far cheaper than the word edge; empty if one has no such letter."""
    plain = [re.match(r"[a-z0-9](?![?*{|])", p) and "|" not in re.sub(r"\([^()]*\)", "", p) for p in patterns]
    return f"(?=[{''.join(sorted({p[0] for p in patterns}))}])" if all(plain) and plain else ""


def any_pattern(patterns: Sequence[str]) -> str:
    """One Unicode-aware pattern for all; edges around every pattern are tested once per position."""
    edge = r"\b"
    if all(p.startswith(edge) and p.endswith(edge) for p in patterns):
        inner = [p.removeprefix(edge).removesuffix(edge) for p in patterns]
        return _first_letters(inner) + BEHIND + "(?:" + "|".join(inner).replace(edge, EDGE) + ")" + AHEAD
    return "|".join(p.replace(edge, EDGE) for p in patterns)


def rule_intent(text: Column, rules: RuleTable = lexicon.INTENT_RULES) -> Column:
    """The first enabled intent one of whose patterns occurs in the text, else null."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    hits = [
        F.when(lowered.rlike(any_pattern(patterns)), F.lit(intent))
        for intent, enabled, patterns in rules
        if enabled
    ]
    return F.coalesce(*hits, F.lit(None).cast("string"))


def keyword_compatibility(
    text: Column, intent: str, keywords: Mapping[str, Sequence[str]] = lexicon.INTENT_KEYWORDS
) -> Column:
    """Share of the intent's keywords that occur in the text; 0 for an unknown intent or an empty list."""
    terms = keywords.get(intent, ())
    if not terms:
        return F.lit(0.0)
    lowered = F.lower(F.coalesce(text, F.lit("")))
    matched = sum((F.contains(lowered, F.lit(term)).cast("int") for term in terms), F.lit(0))
    return matched.cast("double") / F.lit(float(len(terms)))


def _decision(action: str, reason: str) -> Column:
    return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))


def route(intent: Column, similarity: Column, compatibility: Column, combined: Column) -> Column:
    """The triage decision with its reason; a message without any case passes null scores."""
    similarity = F.coalesce(similarity, F.lit(0.0))
    return (
        F.when(intent == lexicon.SECURITY_INTENT, _decision("ESCALATE", lexicon.REASON_SECURITY))
        .when(intent == lexicon.BILLING_INTENT, _decision("ESCALATE", lexicon.REASON_BILLING))
        .when(similarity < lexicon.WEAK_SIMILARITY, _decision("CLARIFY", lexicon.REASON_NO_CASE))
        .when(
            (similarity >= lexicon.STRONG_SIMILARITY) & (compatibility < lexicon.WEAK_COMPATIBILITY),
            _decision("CLARIFY", lexicon.REASON_INCOMPATIBLE),
        )
        .when(combined < lexicon.WEAK_COMBINED, _decision("CLARIFY", lexicon.REASON_MODERATE))
        .otherwise(_decision("ANSWER", lexicon.REASON_RELEVANT))
    )


def escalation_gate(
    intent: Column, confidence: Column, similarity: Column, escalation_label: Column | None = None
) -> Column:
    """The stand-alone gate: other bands than :func:`route`, and an explicit label wins."""
    label = F.lit(None).cast("string") if escalation_label is None else escalation_label
    return (
        F.when(label == "YES", _decision("ESCALATE", lexicon.REASON_LABELLED))
        .when(intent == lexicon.SECURITY_INTENT, _decision("ESCALATE", lexicon.REASON_SECURITY))
        .when(intent == lexicon.BILLING_INTENT, _decision("ESCALATE", lexicon.REASON_BILLING))
        .when(
            (confidence < lexicon.WEAK_CONFIDENCE) & (similarity < lexicon.WEAK_SIMILARITY),
            _decision("CLARIFY", lexicon.REASON_ALL_LOW),
        )
        .when(similarity >= lexicon.STRONG_SIMILARITY, _decision("ANSWER", lexicon.REASON_SIMILAR))
        .when(similarity >= lexicon.WEAK_SIMILARITY, _decision("CLARIFY", lexicon.REASON_GATE_MODERATE))
        .otherwise(_decision("ESCALATE", lexicon.REASON_NO_CASE))
    )


def _reply(response: Column | str, grounded: bool, needs_escalation: bool) -> Column:
    response = F.lit(response) if isinstance(response, str) else response
    return F.struct(
        response.alias("response"),
        F.lit(grounded).alias("grounded"),
        F.lit(needs_escalation).alias("needs_escalation"),
    )


def grounded_reply(similarity: Column, support_text: Column) -> Column:
    """Reply by similarity band from the best case; a null similarity means that there is no case."""
    cleaned = tx.clean_reply(support_text)
    return (
        F.when(similarity.isNull(), _reply(lexicon.REPLY_NO_CASES, False, True))
        .when(similarity < lexicon.WEAK_SIMILARITY, _reply(lexicon.REPLY_WEAK, False, True))
        .when(cleaned == "", _reply(lexicon.REPLY_NO_TEXT, False, True))
        .when(similarity < lexicon.STRONG_SIMILARITY, _reply(lexicon.REPLY_MODERATE, True, False))
        .otherwise(_reply(cleaned, True, False))
    )


def action_reply(action: Column, similarity: Column, support_text: Column) -> Column:
    """The reply of a routed message: grounded for ANSWER, a fixed text for the other actions."""
    return (
        F.when(action == "ANSWER", grounded_reply(similarity, support_text))
        .when(action == "CLARIFY", _reply(lexicon.REPLY_CLARIFY, False, False))
        .otherwise(_reply(lexicon.REPLY_ESCALATE, False, True))
    )
