"""Bucket and label columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds that downstream reports group by.
ON_TIME, LATE, NOT_DELIVERED = "on_time", "late", "not_delivered"
SATISFACTION = ("satisfied", "neutral", "dissatisfied", "no_review")
DELIVERY_BUCKETS = ((7, "0-7 days"), (14, "8-14 days"), (21, "15-21 days"), (30, "22-30 days"))
DELIVERY_BUCKET_REST = "over 30 days"
SEGMENTS = ("Champions", "Loyal", "At Risk", "Lost")
RISK_LEVELS = ((0.7, "very high"), (0.5, "high"), (0.3, "medium"))
RISK_BADGES = ((0.7, "high"), (0.4, "medium"))
CHURN_AFTER_DAYS = 90


def first_match(cases: Sequence[tuple[Column, Any]], otherwise: Any) -> Column:
    """The value of the first condition that holds."""
    label = F.lit(otherwise)
    for condition, name in reversed(cases):
        label = F.when(condition, F.lit(name)).otherwise(label)
    return label


def delivery_status(days_early: Column) -> Column:
    return first_match([(days_early.isNull(), NOT_DELIVERED), (days_early >= 0, ON_TIME)], LATE)


def satisfaction(score: Column) -> Column:
    """An average strictly between 3 and 4 counts as dissatisfied: only exactly 3 is neutral."""
    good, middle, bad, none = SATISFACTION
    return first_match([(score >= 4, good), (score == 3, middle), (score >= 1, bad)], none)


def delivery_bucket(days: Column) -> Column:
    return first_match([(days <= upper, name) for upper, name in DELIVERY_BUCKETS], DELIVERY_BUCKET_REST)


def churn_flag(recency: Column, after_days: int = CHURN_AFTER_DAYS) -> Column:
    """1 when the last purchase is more than ``after_days`` ago; an unknown recency counts as active."""
    return F.coalesce((recency > after_days).cast("int"), F.lit(0))


def at_least(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    return first_match([(value >= lower, name) for lower, name in steps], otherwise)


def risk_level(probability: Column) -> Column:
    return at_least(probability, RISK_LEVELS, "low")


def risk_badge(probability: Column) -> Column:
    return at_least(probability, RISK_BADGES, "low")


def named(ids: Column, names: Mapping[int, str], otherwise: str = "Unknown") -> Column:
    return first_match([(ids == i, name) for i, name in sorted(names.items())], otherwise)
