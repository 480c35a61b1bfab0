"""Nested documents per order, customer, product and seller, and the tagged summaries stored beside them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.measures import mean, mean_of_ratios, rows, total
from souk.plans import reports
from souk.plans.rfm import CUSTOMER
from souk.plans.silver import translated_products, with_defaults
from souk.sources.tables import Tables

# The nested parts of an order document, as target field -> source column.
ORDER_PARTS = {
    "customer": {
        "customer_id": "customer_id",
        "customer_unique_id": "customer_unique_id",
        "customer_city": "customer_city",
        "customer_state": "customer_state",
        "customer_zip_code_prefix": "customer_zip_code_prefix",
    },
    "items": {
        "total_items": "total_items",
        "total_price": "total_price",
        "total_freight_value": "total_freight_value",
        "unique_products": "unique_products",
        "unique_sellers": "unique_sellers",
        "category": "main_category_english",
        "seller_city": "seller_city",
        "seller_state": "seller_state",
    },
    "payment": {
        "total_payment_value": "total_payment_value",
        "payment_type": "payment_type",
        "installments": "max_installments",
        "payment_count": "payment_count",
    },
    "review": {
        "review_score": "review_score",
        "review_comment_title": "review_comment_title",
        "review_comment_message": "review_comment_message",
        "review_count": "review_count",
        "satisfaction_level": "satisfaction_level",
    },
}
# Column names of the order documents and summaries.
ORDER_HEAD = (
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
ORDER_TAIL = (
    "delivery_days",
    "estimated_vs_actual",
    "freight_ratio",
    "order_value",
    "delivery_status",
    "purchase_hour",
    "purchase_dayofweek",
    "purchase_month",
    "purchase_year",
    "purchase_year_month",
)

# What a missing value becomes in each kind of document.
CUSTOMER_DEFAULTS = {"segment_name": "Unknown", "churn_prediction": 0.0, "churn_probability": 0.0}
PRODUCT_DEFAULTS = {
    "total_orders": 0,
    "total_revenue": 0.0,
    "avg_price": 0.0,
    "category_en": "unknown",
    "avg_review_score": 0.0,
    "review_count": 0,
}
SELLER_DEFAULTS = {
    "total_items_sold": 0,
    "total_orders": 0,
    "total_revenue": 0.0,
    "avg_price": 0.0,
    "avg_review_score": 0.0,
    "avg_delivery_days": 0.0,
    "unique_customers": 0,
}


def order_documents(orders: DataFrame) -> DataFrame:
    parts = [
        F.struct(*(F.col(source).alias(field) for field, source in fields.items())).alias(part)
        for part, fields in ORDER_PARTS.items()
    ]
    return orders.select(*ORDER_HEAD, *parts, *ORDER_TAIL)


def order_summary(orders: DataFrame) -> DataFrame:
    """A flat projection of the columns most reports start from."""
    return orders.select(
        "order_id",
        CUSTOMER,
        F.col("order_status").alias("status"),
        F.col("main_category_english").alias("category"),
        "total_items",
        "order_value",
        F.col("max_installments").alias("installments"),
    )


def customer_documents(
    scored: DataFrame, segments: DataFrame | None = None, predictions: DataFrame | None = None
) -> DataFrame:
    """Customer scores with segment and churn prediction; both inputs may be missing."""
    documents = scored.select(
        CUSTOMER,
        "customer_state",
        "customer_city",
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
        "last_purchase_date",
        "first_purchase_date",
    )
    if segments is None:
        documents = documents.withColumns(
            {"cluster": F.lit(None).cast("int"), "segment_name": F.lit(None).cast("string")}
        )
    else:
        documents = documents.join(segments.select(CUSTOMER, "cluster", "segment_name"), CUSTOMER, "left")
    if predictions is None:
        nothing = F.lit(None).cast("double")
        documents = documents.withColumns({"churn_prediction": nothing, "churn_probability": nothing})
    else:
        taken = predictions.select(CUSTOMER, F.col("prediction").alias("churn_prediction"), "churn_probability")
        documents = documents.join(taken, CUSTOMER, "left")
    return with_defaults(documents, CUSTOMER_DEFAULTS)


def product_sales(items: DataFrame) -> DataFrame:
    """Totals combine map-side to one row per product and task; distinct counts, which cannot, are kept apart."""
    totals = items.groupBy("product_id").agg(
        rows().alias("total_orders"),
        total("price").alias("total_revenue"),
        mean("price").alias("avg_price"),
        F.min("price").cast("double").alias("min_price"),
        F.max("price").cast("double").alias("max_price"),
        total("freight_value").alias("total_freight"),
        mean("freight_value").alias("avg_freight"),
    )
    varieties = items.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("unique_orders"), F.count_distinct("seller_id").alias("seller_count")
    )
    return totals.join(varieties, "product_id", "left")


def product_reviews(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Average order score per product. An order with several items of a product counts once per item.

    ``orders`` should be the written silver table: then the join shuffles both of its sides itself, and AQE can split
    an order that holds a large part of the items. The aggregate after it combines map-side, so a hot product is
    one row per task.
    """
    scores = reports.reviewed(orders).select("order_id", "review_score")
    return (
        items.select("order_id", "product_id")
        .join(scores, "order_id")
        .groupBy("product_id")
        .agg(mean_of_ratios("review_score").alias("avg_review_score"), F.count("review_score").alias("review_count"))
    )


def product_documents(orders: DataFrame, tables: Tables) -> DataFrame:
    joined = (
        translated_products(tables.products, tables.category_translation)
        .join(product_sales(tables.order_items), "product_id", "left")
        .join(product_reviews(orders, tables.order_items), "product_id", "left")
    )
    documents = joined.select(
        "product_id",
        F.col("product_category_name").alias("category_pt"),
        F.col("product_category_name_english").alias("category_en"),
        *(c for c in tables.products.columns if c not in ("product_id", "product_category_name")),
        "total_orders",
        "total_revenue",
        "avg_price",
        "min_price",
        "max_price",
        "total_freight",
        "avg_freight",
        "unique_orders",
        "seller_count",
        "avg_review_score",
        "review_count",
    )
    return with_defaults(documents, PRODUCT_DEFAULTS)


def seller_sales(items: DataFrame) -> DataFrame:
    totals = items.groupBy("seller_id").agg(
        rows().alias("total_items_sold"),
        total("price").alias("total_revenue"),
        mean("price").alias("avg_price"),
        total("freight_value").alias("total_freight"),
        mean("freight_value").alias("avg_freight"),
    )
    varieties = items.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("total_orders"), F.count_distinct("product_id").alias("unique_products")
    )
    return totals.join(varieties, "seller_id", "left")


def seller_metrics(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Reviews, delivery, customers and sale dates per seller, weighted by item. As for ``product_reviews``,
    ``orders`` should be the written silver table."""
    at = "order_purchase_timestamp"
    facts = orders.filter(F.col("seller_state").isNotNull()).select(
        "order_id", CUSTOMER, "review_score", "delivery_days", at
    )
    return (
        items.select("order_id", "seller_id")
        .join(facts, "order_id")
        .groupBy("seller_id")
        .agg(
            mean_of_ratios("review_score").alias("avg_review_score"),
            mean("delivery_days").alias("avg_delivery_days"),
            F.count_distinct(CUSTOMER).alias("unique_customers"),
            F.min(at).alias("first_sale_date"),
            F.max(at).alias("last_sale_date"),
        )
    )


def seller_documents(orders: DataFrame, tables: Tables) -> DataFrame:
    documents = (
        tables.sellers.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix")
        .join(seller_sales(tables.order_items), "seller_id", "left")
        .join(seller_metrics(orders, tables.order_items), "seller_id", "left")
    )
    return with_defaults(documents, SELLER_DEFAULTS)


# Summaries

# What the order summaries read, for callers that write or persist it first.
SUMMARY_COLUMNS = (
    CUSTOMER,
    "customer_state",
    "purchase_year_month",
    "purchase_dayofweek",
    "purchase_hour",
    "main_category_english",
    "payment_type",
    "max_installments",
    "total_items",
    "total_payment_value",
    "review_score",
    "delivery_days",
    "order_purchase_timestamp",
)


def gold_monthly(orders: DataFrame) -> DataFrame:
    value = reports.payment_mean("avg_order_value")
    return reports.by(
        orders,
        "purchase_year_month",
        reports.order_count(),
        reports.revenue(),
        value,
        reports.customer_count(),
        reports.review_mean(),
        reports.delivery_mean(),
    ).orderBy("purchase_year_month")


def gold_category(orders: DataFrame) -> DataFrame:
    return reports.category_revenue(orders).orderBy(F.desc("total_revenue"), "main_category_english")


def gold_state(orders: DataFrame) -> DataFrame:
    value = reports.payment_mean("avg_order_value")
    return reports.by(
        orders,
        "customer_state",
        reports.order_count(),
        reports.revenue(),
        value,
        reports.customer_count(),
        reports.review_mean(),
        reports.delivery_mean(),
    ).orderBy(F.desc("total_revenue"), "customer_state")


def gold_hourly(orders: DataFrame) -> DataFrame:
    cells = ["purchase_dayofweek", "purchase_hour"]
    return reports.by(orders, cells, reports.order_count(), reports.revenue()).orderBy(*cells)


def gold_payment(orders: DataFrame) -> DataFrame:
    return reports.by(
        orders,
        "payment_type",
        reports.order_count(),
        reports.revenue(),
        reports.payment_mean("avg_payment_value"),
        mean("max_installments").alias("avg_installments"),
    ).orderBy(F.desc("order_count"), "payment_type")


def segment_stats(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("segment_name")
        .agg(
            rows().alias("customer_count"),
            mean("recency").alias("avg_recency"),
            mean("frequency").alias("avg_frequency"),
            mean("monetary").alias("avg_monetary"),
        )
        .orderBy(F.desc("avg_monetary"))
    )


def tagged_union(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """Summaries of different shapes in one table, told apart by ``agg_type``; absent columns are NULL."""
    tagged = [df.withColumn("agg_type", F.lit(name)) for name, df in summaries.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def summaries(
    orders: DataFrame, segments: DataFrame | None = None, models: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The summaries that make up the collection of aggregates, by kind."""
    found = {
        "monthly_revenue": gold_monthly(orders),
        "category_stats": gold_category(orders),
        "state_stats": gold_state(orders),
        "hourly_orders": gold_hourly(orders),
        "payment_methods": gold_payment(orders),
    }
    if models is not None:
        found["model_performance"] = models
    if segments is not None:
        found["segment_stats"] = segment_stats(segments)
    return found


def aggregations_union(
    orders: DataFrame, segments: DataFrame | None = None, models: DataFrame | None = None
) -> DataFrame:
    return tagged_union(summaries(orders, segments, models))
