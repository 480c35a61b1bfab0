"""Recency, frequency and monetary value per customer, their quartile scores, and the churn flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.dates import days_between
from souk.functions.labels import churn_flag
from souk.functions.measures import mean, mean_of_ratios
from souk.operators.ordering import asc, desc
from souk.operators.ranking import distributed_ntile
from souk.operators.staging import stage

CUSTOMER = "customer_unique_id"
SCORE_KEYS = {
    "r_score": [asc("recency"), asc(CUSTOMER)],
    "f_score": [desc("frequency"), asc(CUSTOMER)],
    "m_score": [desc("monetary"), asc(CUSTOMER)],
}
# The order columns that customer figures read.
INPUT_COLUMNS = (
    CUSTOMER,
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    "total_payment_value",
    "review_score",
    "delivery_days",
    "total_items",
    "customer_state",
    "customer_city",
)
# The customer columns that an order carries.
ORDER_COLUMNS = (
    "recency",
    "frequency",
    "monetary",
    "r_score",
    "f_score",
    "m_score",
    "rfm_score",
    "avg_review_score",
    "avg_delivery_days",
    "customer_tenure_days",
)


def last_purchase(orders: DataFrame) -> Column:
    """The latest purchase as a scalar subquery: the anchor never passes through the driver."""
    return orders.agg(F.max("order_purchase_timestamp")).scalar()


def rfm_customers(orders: DataFrame, reviewed_only: bool = False) -> DataFrame:
    """One row per customer with a delivered order.

    Orders without a customer are nobody's and left out. ``orders`` has one row per order (silver), so counting rows
    counts orders. State and city are those of the
    latest order. Orders without a review enter the average with score 0 unless ``reviewed_only``.
    """
    score = F.col("review_score")
    scored = F.when(score > 0, score) if reviewed_only else score
    delivered = orders.filter(F.col("order_status") == "delivered")
    at = "order_purchase_timestamp"
    latest = F.max(F.struct(at, "order_id", "customer_state", "customer_city"))
    per_customer = delivered.filter(F.col(CUSTOMER).isNotNull()).groupBy(CUSTOMER).agg(
        F.count("order_id").alias("frequency"),
        F.sum("total_payment_value").alias("monetary"),
        mean_of_ratios(scored).alias("avg_review_score"),
        mean("delivery_days").alias("avg_delivery_days"),
        mean("total_items").alias("avg_items_per_order"),
        latest.getField("customer_state").alias("customer_state"),
        latest.getField("customer_city").alias("customer_city"),
        F.max(at).alias("last_purchase_date"),
        F.min(at).alias("first_purchase_date"),
    )
    return per_customer.select(
        CUSTOMER,
        days_between(F.col("last_purchase_date"), last_purchase(delivered)).alias("recency"),
        *(c for c in per_customer.columns if c != CUSTOMER),
        days_between(F.col("first_purchase_date"), F.col("last_purchase_date")).alias("customer_tenure_days"),
    )


def with_scores(customers: DataFrame) -> DataFrame:
    """Quartile scores, 1 = best; ties go by customer id. The sum runs from 3 (best) to 12 (worst).

    The customer table is staged, so the three sorts read it back instead of computing it again.
    """
    staged = stage(customers)
    scores = {name: distributed_ntile(staged, 4, keys) for name, keys in SCORE_KEYS.items()}
    scored = staged.withColumns(scores)
    return scored.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def rfm_scores(orders: DataFrame) -> DataFrame:
    return with_scores(rfm_customers(orders))


def orders_with_rfm(orders: DataFrame, scored: DataFrame) -> DataFrame:
    """Orders with their customer's scores and the churn flag. Customers without a delivered order keep NULL
    scores and churn 0."""
    joined = orders.join(scored.select(CUSTOMER, *ORDER_COLUMNS), CUSTOMER, "left")
    return joined.withColumn("churn", churn_flag(F.col("recency")))
