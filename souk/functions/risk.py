"""The composite churn risk: five scaled inputs, weighted."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weight of each factor, and whether a high value means risk.
WEIGHTS = {
    "recency": (0.30, True),
    "frequency": (0.15, False),
    "monetary": (0.15, False),
    "review": (0.20, False),
    "delivery": (0.20, True),
}
LABEL_ABOVE = 0.50


@dataclass(frozen=True)
class Scale:
    """Linear scaling of one factor to 0..1; each end is clamped only if its flag is set."""

    low: float
    high: float
    clamp_low: bool = False
    clamp_high: bool = False

    def apply(self, value: Column) -> Column:
        if self.high <= self.low:
            return F.lit(0.0)
        scaled = (value.cast("double") - F.lit(float(self.low))) / F.lit(float(self.high - self.low))
        if self.clamp_high:
            scaled = F.when(scaled > 1.0, 1.0).otherwise(scaled)
        if self.clamp_low:
            scaled = F.when(scaled < 0.0, 0.0).otherwise(scaled)
        return scaled


# The scales used for training. Only upper ends are clamped, so a customer without any review
# (average 0) scales below 0 on the review factor; the review factor itself has no clamp.
TRAINING_SCALES = {
    "recency": Scale(0, 730, clamp_high=True),
    "frequency": Scale(1, 20, clamp_high=True),
    "monetary": Scale(0, 5000, clamp_high=True),
    "review": Scale(1, 5),
    "delivery": Scale(0, 60, clamp_high=True),
}

# The scales used when scoring customers for the dashboard; both ends are clamped.
SERVING_SCALES = {
    "recency": Scale(0, 730, True, True),
    "frequency": Scale(1, 20, True, True),
    "monetary": Scale(0, 14000, True, True),
    "review": Scale(1, 5, True, True),
    "delivery": Scale(0, 200, True, True),
}
SERVING_RANGE = (0.01, 0.99)


def weighted_risk(scaled: Mapping[str, Column]) -> Column:
    terms = [
        F.lit(weight) * (scaled[factor] if high_is_risk else F.lit(1.0) - scaled[factor])
        for factor, (weight, high_is_risk) in WEIGHTS.items()
    ]
    risk = terms[0]
    for term in terms[1:]:
        risk = risk + term
    return risk


def composite_risk(factors: Mapping[str, str], scales: Mapping[str, Scale] = TRAINING_SCALES) -> Column:
    """``factors`` maps each factor to its column. A NULL input gives a NULL risk, so fill defaults first."""
    return weighted_risk({f: scales[f].apply(F.col(c)) for f, c in factors.items()})


def serving_risk(factors: Mapping[str, str]) -> Column:
    lowest, highest = SERVING_RANGE
    risk = composite_risk(factors, SERVING_SCALES)
    within = F.when(risk < lowest, lowest).when(risk > highest, highest).otherwise(risk)
    return F.round(within, 3)


def minmax_risk(df: DataFrame, factors: Mapping[str, str]) -> Column:
    """Risk with each factor scaled to the smallest and largest value in ``df`` (0 if they are equal).

    The ten bounds come from one aggregate, read as a scalar subquery: no driver round trip and no join.
    """
    ends = [
        end(F.col(c).cast("double")).alias(f"{f}_{name}")
        for f, c in factors.items()
        for name, end in (("low", F.min), ("high", F.max))
    ]
    bounds = df.agg(F.struct(*ends).alias("bounds")).scalar()
    scaled = {}
    for f, c in factors.items():
        low, high = bounds.getField(f"{f}_low"), bounds.getField(f"{f}_high")
        scaled[f] = F.coalesce(F.try_divide(F.col(c).cast("double") - low, high - low), F.lit(0.0))
    return weighted_risk(scaled)
