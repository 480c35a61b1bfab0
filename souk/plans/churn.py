"""Churn features, labels, class weights and risk scores per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions import labels, risk
from souk.functions.measures import mean, rows, rows_where
from souk.plans.rfm import CUSTOMER
from souk.plans.silver import with_defaults

FEATURES = ("recency", "frequency", "monetary", "avg_review", "avg_delivery_days")
FACTORS = dict(zip(risk.WEIGHTS, FEATURES, strict=True))
DOCUMENT_FACTORS = FACTORS | {"review": "avg_review_score"}

# What a missing input becomes before training and before scoring.
TRAINING_DEFAULTS = {"recency": 0, "frequency": 1, "monetary": 0, "avg_review": 4, "avg_delivery_days": 10}
SERVING_DEFAULTS = {"recency": 0, "frequency": 1, "monetary": 0, "avg_review_score": 3, "avg_delivery_days": 10}


def churn_features(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The five model inputs of every customer with a delivered order.

    Delivery days are averaged over all orders of the customer, delivered or not; the review average is the one in
    the customer table. Both sides are one row per customer and share its partitioning.
    """
    delivery = orders.groupBy(CUSTOMER).agg(mean("delivery_days").alias("avg_delivery_days"))
    inputs = customers.select(
        CUSTOMER,
        "recency",
        "frequency",
        F.col("monetary").cast("double").alias("monetary"),
        F.col("avg_review_score").alias("avg_review"),
    )
    return with_defaults(inputs.join(delivery, CUSTOMER), TRAINING_DEFAULTS)


def with_risk(features: DataFrame) -> DataFrame:
    """Composite risk and the label derived from it.

    The label is a formula of the model's own inputs, so a model's score on it says how well the formula is
    recovered, not how well future churn is foreseen.
    """
    scored = features.withColumn("risk", risk.composite_risk(FACTORS))
    return scored.withColumn("label", (F.col("risk") > risk.LABEL_ABOVE).cast("double"))


def minmax_risk(customers: DataFrame) -> DataFrame:
    """Risk scaled to the range of each factor in the table; missing values count as 0."""
    present = with_defaults(
        customers.select(CUSTOMER, *DOCUMENT_FACTORS.values()), dict.fromkeys(DOCUMENT_FACTORS.values(), 0)
    )
    scored = present.withColumn("risk", F.round(risk.minmax_risk(present, DOCUMENT_FACTORS), 6))
    return scored.withColumn("label", (F.col("risk") > risk.LABEL_ABOVE).cast("int"))


def with_levels(scored: DataFrame) -> DataFrame:
    probability = F.col("probability")
    return scored.withColumns(
        {
            "at_risk": probability >= risk.LABEL_ABOVE,
            "risk_level": labels.risk_level(probability),
            "risk_badge": labels.risk_badge(probability),
        }
    )


def serving_scores(customers: DataFrame) -> DataFrame:
    """Probability, yes/no label and level for every customer."""
    inputs = with_defaults(customers.select(CUSTOMER, *DOCUMENT_FACTORS.values()), SERVING_DEFAULTS)
    return with_levels(inputs.select(CUSTOMER, risk.serving_risk(DOCUMENT_FACTORS).alias("probability")))


def risk_levels(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_level", "risk_badge").agg(rows().alias("customer_count")).orderBy("risk_level")


def class_weights(labelled: DataFrame) -> DataFrame:
    """Weight n / (2 n_c) of each class; 1 for a class without rows."""
    counts = labelled.agg(
        rows().alias("n"),
        rows_where(F.col("label") == 0).alias("n_0"),
        rows_where(F.col("label") == 1).alias("n_1"),
    )

    def one(label: float, of_class: str):
        weight = F.try_divide(F.col("n").cast("double"), 2 * F.col(of_class))
        return F.struct(
            F.lit(label).alias("label"),
            F.col(of_class).alias("customer_count"),
            F.coalesce(weight, F.lit(1.0)).alias("weight"),
        )

    return counts.select(F.inline(F.array(one(0.0, "n_0"), one(1.0, "n_1"))))


def with_class_weight(labelled: DataFrame) -> DataFrame:
    """Add the class weight. The weights are two rows, so their broadcast has a fixed size."""
    return labelled.join(F.broadcast(class_weights(labelled).select("label", "weight")), "label")
