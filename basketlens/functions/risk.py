"""Expressions over scores: risk levels, decisions, closeness, recommendations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Risk levels and the upper bounds of their probability bins.
RISK_LEVELS = ("Faible", "Moyen", "Élevé", "Critique")
RISK_BOUNDS = (0.25, 0.5, 0.75, 1.0)
HIGH_RISK = ("Élevé", "Critique")
DECISION_THRESHOLD = 0.5

# Actions proposed per risk level, in order.
URGENT_ACTIONS = ("retention_campaign", "exclusive_discount", "support_contact", "analyse_dissatisfaction")
MODERATE_ACTIONS = ("reengagement_email", "loyalty_programme", "watch_purchases")
LOYAL_ACTIONS = ("newsletter_recommendations", "vip_programme", "referral_and_reviews")
URGENT_UPLIFT_ACTION = "high_potential_retention"
LOYAL_UPLIFT_ACTION = "premium_products"
SEGMENT_ACTION = "adapt_to_segment_"


def risk_level(p: Column, closed: str = "right") -> Column:
    """Risk level of a probability.

    ``closed="right"`` is the batch report's binning (a bound belongs to the lower
    level; 0, and anything outside (0, 1], has no level). ``closed="left"`` is the
    per-record binning (a bound belongs to the upper level).
    """
    if closed not in ("left", "right"):
        raise ValueError("closed must be 'left' or 'right'")
    if closed == "right":
        level = F.when(p <= 0, None)
        for name, bound in zip(RISK_LEVELS, RISK_BOUNDS):
            level = level.when(p <= bound, name)
        return level
    level = F.when(p.isNull(), None)
    for name, bound in zip(RISK_LEVELS, RISK_BOUNDS[:-1]):
        level = level.when(p < bound, name)
    return level.otherwise(RISK_LEVELS[-1])


def risk_rank(level: Column) -> Column:
    """Position of a level in ascending order of risk, for sorting."""
    rank = F.when(level == RISK_LEVELS[0], 0)
    for i, name in enumerate(RISK_LEVELS[1:], 1):
        rank = rank.when(level == name, i)
    return rank


def is_high_risk(level: Column) -> Column:
    return F.coalesce(level.isin(*HIGH_RISK), F.lit(False))


def decide(p: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return (p >= threshold).cast("int")


def closeness(distances: Column) -> Column:
    """Per centre: 100 for the nearest, 0 for the farthest, one decimal."""
    far, near = F.array_max(distances), F.array_min(distances)
    spread = F.when(far != near, far - near).otherwise(F.lit(1.0))
    return F.transform(distances, lambda d: F.round((far - d) / spread * 100, 1))


def spend_delta(predicted: Column, entered: Column) -> Column:
    return predicted - entered


def recommendations(level: Column, predicted_spend: Column, entered_spend: Column, segment: Column) -> Column:
    """Ordered action codes for a customer; a missing spend or segment adds none."""
    urgent = level.isin(*HIGH_RISK)
    moderate = level == "Moyen"
    loyal = level == RISK_LEVELS[0]

    def when_all(condition: Column, actions: tuple[str, ...]) -> list[Column]:
        return [F.when(condition, F.lit(a)) for a in actions]

    return F.array_compact(
        F.array(
            *when_all(urgent, URGENT_ACTIONS),
            F.when(urgent & (predicted_spend > entered_spend), URGENT_UPLIFT_ACTION),
            *when_all(moderate, MODERATE_ACTIONS),
            *when_all(loyal, LOYAL_ACTIONS),
            F.when(loyal & predicted_spend.isNotNull(), LOYAL_UPLIFT_ACTION),
            F.when(level.isNotNull() & segment.isNotNull(), F.concat(F.lit(SEGMENT_ACTION), segment.cast("string"))),
        )
    )
