"""Scores and what to do about them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Probability marks of the three tiers and the advice attached to each.
CRITICAL_ABOVE = 0.75
AT_RISK_FROM = 0.50
TIERS = {
    "Critical": ("Immediate Intervention", "Apology and free shipping e-mail if delivery took more than 7 days"),
    "At Risk": ("Nudge Campaign", "Personalised product recommendations"),
    "Safe": ("Do Not Disturb", "No marketing; save budget"),
}


def risk_tier(probability: Column) -> Column:
    """Critical above 0.75, At Risk from 0.50 to 0.75 inclusive, Safe below."""
    return (
        F.when(probability > CRITICAL_ABOVE, "Critical")
        .when(probability >= AT_RISK_FROM, "At Risk")
        .when(probability.isNotNull(), "Safe")
    )


def _advice(tier: Column, position: int) -> Column:
    chosen = F.lit(None).cast("string")
    for name, advice in TIERS.items():
        chosen = F.when(tier == name, advice[position]).otherwise(chosen)
    return chosen


def tier_strategy(tier: Column) -> Column:
    return _advice(tier, 0)


def tier_action(tier: Column) -> Column:
    return _advice(tier, 1)


def impact_direction(coefficient: Column) -> Column:
    """Positive coefficients push people away, the others keep them."""
    return F.when(coefficient > 0, "Increases Churn Risk").otherwise("Increases Loyalty")


def logistic(weights: Mapping[str, float], intercept: float, prefix: str = "") -> Column:
    """Probability of a stored linear model as plain column arithmetic (no model object needed)."""
    linear = F.lit(float(intercept))
    for name, weight in weights.items():
        linear = linear + F.lit(float(weight)) * F.col(prefix + name)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))
