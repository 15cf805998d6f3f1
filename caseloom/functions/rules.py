"""Ordered, auditable rules compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import matches_any, no_dm_preference

Rules = Sequence[tuple[str, str]]


def first_rule(c: Column, rules: Rules, default: str, ignore_case: bool = True) -> Column:
    """Name of the first rule whose pattern is found, else the default."""
    chain = None
    for name, pattern in rules:
        hit = matches_any(c, [pattern], ignore_case)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return F.lit(default) if chain is None else chain.otherwise(default)


def bucket_intent(c: Column, rules: Rules = fv.INTENT_RULES, default: str = fv.CATCH_ALL) -> Column:
    """Rough intent for stratification: lower-cased text, exact patterns."""
    return first_rule(F.lower(c), rules, default, ignore_case=False)


def simple_intent(c: Column, rules: Rules = fv.INTENT_RULES, default: str = fv.CATCH_ALL) -> Column:
    """Keyword baseline: same rules, case folded by the patterns instead."""
    return first_rule(c, rules, default)


def simple_routing(c: Column,
                   patterns: Sequence[str] = fv.BASELINE_ESCALATION_PATTERNS) -> Column:
    return first_rule(c, [(fv.ESCALATE, p) for p in patterns], fv.AUTO_HANDLE)


def simple_reply_template(label: Column,
                          templates: Mapping[str, str] = fv.REPLY_TEMPLATES) -> Column:
    pairs = [F.lit(x) for item in templates.items() for x in item]
    return F.create_map(*pairs)[label]


def dm_vote(precedents: Column) -> Column:
    """True where there are precedents and every one was moved to DM."""
    all_moved = F.forall(precedents, lambda p: F.coalesce(p["is_dm_redirect"], F.lit(False)))
    return F.coalesce((F.size(precedents) > 0) & all_moved, F.lit(False))


@dataclass(frozen=True)
class RoutingRules:
    """What sends a post to a person, in priority order."""

    escalations: Rules = field(default_factory=lambda: list(fv.ROUTING_RULES))
    opt_out: str = fv.NO_DM_PATTERN
    precedent_reason: str = fv.DM_PRECEDENT_REASON
    stem_prefix: bool = False  # let "explod" also match "exploded"

    def patterns(self) -> Rules:
        if not self.stem_prefix:
            return self.escalations
        return [(reason, p.removesuffix(r"\b")) for reason, p in self.escalations]


def route_decision(text: Column, precedents: Column | None = None,
                   rules: RoutingRules = RoutingRules()) -> Column:
    """struct(routing, reason) from the text first, then its precedents."""
    def outcome(routing: str, reason: str) -> Column:
        return F.struct(F.lit(routing).alias("routing"), F.lit(reason).alias("reason"))

    handled = outcome(fv.AUTO_HANDLE, "")
    chain = None
    for reason, pattern in rules.patterns():
        hit, result = matches_any(text, [pattern]), outcome(fv.ESCALATE, reason)
        chain = F.when(hit, result) if chain is None else chain.when(hit, result)
    opted_out = no_dm_preference(text, rules.opt_out)
    chain = F.when(opted_out, handled) if chain is None else chain.when(opted_out, handled)
    if precedents is not None:
        chain = chain.when(dm_vote(precedents), outcome(fv.ESCALATE, rules.precedent_reason))
    return chain.otherwise(handled)
