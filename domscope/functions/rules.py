"""Rule engines as ordered CASE expressions. Each gives a value and the trail of rules that fired."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import terms as t
from .text import contains_any, norm_blob, norm_key, strings, strip, term_hits, text


def score_label(
    score: Column,
    labels: Sequence[tuple[int, str]] = t.LABELS,
    otherwise: str = t.WEAKEST_LABEL,
) -> Column:
    (at, name), *rest = labels
    out = F.when(score >= at, name)
    for at, name in rest:
        out = out.when(score >= at, name)
    return out.otherwise(otherwise)


def evidence_tier(
    notes: Column,
    sources: Column,
    inferred=t.INFERRED_MARKERS,
    secondary=t.SECONDARY_MARKERS,
    first=t.FIRST_PARTY_MARKERS,
) -> Column:
    """The most cautious marker wins. The text is not stripped: markers may begin or end with a space."""
    blob = F.lower(F.concat(F.coalesce(notes, F.lit("")), F.lit(" "), F.coalesce(sources, F.lit(""))))
    confirmed = F.contains(blob, F.lit("confirmed")) & contains_any(blob, ("official", "terms", "site"))
    return F.when(contains_any(blob, inferred), t.INFERRED).when(contains_any(blob, secondary), t.SECONDARY).when(
        confirmed | contains_any(blob, first),
        t.FIRST,
    ).otherwise(t.INFERRED)


def row_tier(notes: Column, sources: Column, confidence: Column) -> Column:
    base = evidence_tier(notes, sources)
    return F.when(
        (confidence >= 0.9) & (base == t.INFERRED),
        t.SECONDARY,
    ).when(confidence < 0.5, t.INFERRED).otherwise(base)


def tier_rank(tier: Column, ranks: Mapping[str, int] = t.TIER_RANK, unknown: int = 8) -> Column:
    out = F.when(F.coalesce(tier, F.lit("")) == "", ranks[t.INFERRED])
    for name, rank in ranks.items():
        out = out.when(tier == name, rank)
    return out.otherwise(unknown)


def tier_cap(tier: Column) -> Column:
    return F.when(tier == t.FIRST, t.TIER_CAP[t.FIRST]).when(
        tier == t.SECONDARY,
        t.TIER_CAP[t.SECONDARY],
    ).otherwise(t.TIER_CAP[t.INFERRED])


def tier_level(tier: Column) -> Column:
    s = text(tier)
    return F.when(s == t.FIRST, "high").when(s == t.SECONDARY, "medium").otherwise("low")


def downgraded(level: Column) -> Column:
    return F.when(level == "high", "medium").otherwise("low")


def weak_notes(notes: Column, sources: Column) -> Column:
    return contains_any(norm_blob(notes, sources), t.WEAK_NOTE_MARKERS)


def redirect_shell(*parts: Column) -> Column:
    return contains_any(norm_blob(*parts), t.REDIRECT_MARKERS)


def placeholder_domain(domain: Column) -> Column:
    d = F.regexp_replace(strip(F.lower(domain)), r"\.+$", "")
    hit = (
        d.isin(*t.PLACEHOLDER_DOMAINS)
        | F.endswith(d, F.lit(".example.com"))
        | F.endswith(d, F.lit(".example.org"))
        | contains_any(d, t.PLACEHOLDER_FRAGMENTS)
    )
    return (text(domain) == "") | F.coalesce(hit, F.lit(False))


def trail(*steps: Column) -> Column:
    """Reasons of the rules that fired, in order; each step is a string or null."""
    return F.filter(F.array(*steps), lambda x: x.isNotNull())


def _reason(when: Column, *parts) -> Column:
    return F.when(when, F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)))


def _cascade(rules: Sequence[tuple[Column, str, str]], value: str, reason: str) -> tuple[Column, Column]:
    """(value, reason) of the first rule that holds; the last arguments are the default."""
    v = r = None
    for when, val, why in rules:
        when = F.coalesce(when, F.lit(False))
        v = F.when(when, val) if v is None else v.when(when, val)
        r = F.when(when, why) if r is None else r.when(when, why)
    return v.otherwise(value), r.otherwise(reason)


def entity_type(
    blob: Column,
    *,
    raw_type: Column,
    provider_type: Column,
    pattern_fields: Column,
    promotes: Column,
    uses_provider: Column,
    domain: Column,
    legal_anchor: Column,
    operator_terms=t.OPERATOR_TERMS,
    promoter_terms=t.PROMOTER_TERMS,
    provider_terms=t.PROVIDER_TERMS,
    payment_terms=t.PAYMENT_TERMS,
) -> tuple[Column, Column]:
    """(type, reasons): four scores, the largest wins, ties by the order operator, provider, payment path, promoter."""
    points = lambda when, n: F.when(F.coalesce(when, F.lit(False)), n).otherwise(0)
    op, pr, pv, pay = (term_hits(blob, x) for x in (operator_terms, promoter_terms, provider_terms, payment_terms))
    raw = norm_key(F.coalesce(raw_type, F.lit(""))) == "provider"
    typed = text(provider_type) != ""
    no_dot = ~F.contains(F.coalesce(domain, F.lit("")), F.lit(".")) & (text(domain) != "")
    scores = {
        "operator": points(legal_anchor, 2) + 2 * op,
        "provider": points(raw, 6) + points(typed, 4) + 2 * pv + points(uses_provider >= 2, 6),
        "payment_path": 2 * pay + points(pattern_fields, 5) + points(no_dot, 3),
        "promoter": 2 * pr + points(promotes >= 2, 6),
    }
    best = F.greatest(*scores.values())
    kind = F.when(best == 0, "unknown")
    for name, s in scores.items():
        kind = kind.when(s == best, name)
    reasons = trail(
        _reason(raw, "rule:raw_entity_type_provider"),
        _reason(legal_anchor, "rule:legal_entity_anchor_operator_hint"),
        _reason(typed, "rule:provider_type_field_present"),
        _reason(op > 0, "rule:operator_term_hits:", op),
        _reason(pr > 0, "rule:promoter_term_hits:", pr),
        _reason(pv > 0, "rule:provider_term_hits:", pv),
        _reason(pay > 0, "rule:payment_term_hits:", pay),
        _reason(pattern_fields, "rule:domain_or_pattern_fields"),
        _reason(no_dot, "rule:non_hostname_domain_shape"),
        _reason(promotes >= 2, "rule:multiple_promote_targets:", promotes),
        _reason(uses_provider >= 2, "rule:multiple_uses_provider_refs:", uses_provider),
        F.when(best == 0, "rule:insufficient_entity_type_signals").otherwise(
            F.concat(F.lit("rule:selected_type:"), kind, F.lit("_score_"), best.cast("string"))
        ),
    )
    return kind, reasons


def field_confidence(tier: Column, weak: Column, present: Mapping[str, Column]) -> Column:
    """map<field, level> in field order: low without a value, a step down for weak notes on sensitive fields."""
    base = tier_level(tier)
    cells = []
    for name in sorted(present):
        level = F.when(weak, downgraded(base)).otherwise(base) if name in t.SENSITIVE_FIELDS else base
        cells += [F.lit(name), F.when(F.coalesce(present[name], F.lit(False)), level).otherwise("low")]
    return F.create_map(*cells)


def promotion(
    *, kind: Column, tier: Column, legal: Column, attach: Column, strong_cluster: Column, domain_ok: Column,
    weak: Column, contradictory: Column, little_signal: Column, notes: Column,
) -> tuple[Column, Column]:
    first, second = tier == t.FIRST, tier == t.SECONDARY
    typed = kind.isin("operator", "promoter", "provider", "payment_path")
    anchor = legal | attach | strong_cluster
    unclear = little_signal | (kind == "unknown")
    return _cascade(
        [
            (contradictory, "reject_for_now", "rule:promotion_reject_contradictory_signals"),
            (~domain_ok, "reject_for_now", "rule:promotion_reject_domain_placeholder_or_missing"),
            (
                F.contains(F.lower(F.coalesce(notes, F.lit(""))), F.lit("403")) & second,
                "stage_only",
                "rule:promotion_stage_403_secondary",
            ),
            (unclear & strong_cluster & second, "stage_only", "rule:promotion_stage_unknown_but_cluster_and_secondary"),
            (unclear, "reject_for_now", "rule:promotion_reject_weak_or_unknown"),
            (first & typed & anchor & ~weak, "promote_now", "rule:promotion_promote_first_party_strong_anchor"),
            (second & typed & anchor & legal, "promote_now", "rule:promotion_promote_secondary_with_legal_anchor"),
            (
                strong_cluster & typed & (first | second),
                "promote_now",
                "rule:promotion_promote_strong_cluster_multiple_signals",
            ),
            (weak | (tier == t.INFERRED), "stage_only", "rule:promotion_stage_mixed_or_inferred"),
            (second & ~legal, "stage_only", "rule:promotion_stage_secondary_without_legal"),
        ],
        "stage_only",
        "rule:promotion_stage_default",
    )


def blocking(
    *, kind: Column, tier: Column, legal_level: Column, redirect: Column, evidence_only: Column, confirmed: Column,
    touches_confirmed: Column, hits: Column,
) -> tuple[Column, Column]:
    """(recommendation, reasons)."""
    operator, first = kind == "operator", tier == t.FIRST
    sure = (legal_level == "high") | first | (tier == t.SECONDARY) | (hits >= 2)
    value, reason = _cascade(
        [
            (evidence_only & (kind == "provider"), "do_not_block", "rule:block_do_not_evidence_only_provider"),
            (kind == "promoter", "do_not_block", "rule:block_do_not_promoter_listing_domain"),
            (kind == "provider", "do_not_block", "rule:block_do_not_provider_studio_domain"),
            (confirmed, "block_now", "rule:block_now_confirmed_operator_seed_or_catalog"),
            (operator & first, "block_now", "rule:block_now_operator_first_party"),
            (redirect & operator & sure, "block_now", "rule:block_now_redirect_shell_operator"),
            (redirect & operator, "block_after_review", "rule:block_after_review_redirect_shell_operator"),
            (
                operator & touches_confirmed,
                "block_after_review",
                "rule:block_after_review_operator_cluster_known_family",
            ),
            (operator & (hits >= 4), "block_now", "rule:block_now_high_confidence_sweeps_operator_signals"),
            (operator & (hits >= 2), "block_after_review", "rule:block_after_review_operator_sweeps_signals"),
            (operator, "block_after_review", "rule:block_after_review_operator_mixed"),
        ],
        "do_not_block",
        "rule:block_do_not_weak_or_unknown",
    )
    both = (reason == "rule:block_now_operator_first_party") & F.coalesce(redirect, F.lit(False))
    return value, F.concat(
        F.when(both, strings("rule:block_now_redirect_shell_operator")).otherwise(strings()),
        F.array(reason),
    )
