"""The tables behind the dashboard pages: KPIs, segments, churn, geography, logistics, lookups.

``orders`` is the silver order table, ``customers`` the customer documents, ``products`` the product documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.categories import with_display_name
from souk.functions.dates import monday_first, month_of
from souk.functions.measures import mean, mean_of_ratios, percent, rounded_or_zero, rows, rows_where, total
from souk.operators import rows as pick
from souk.operators.ordering import Key, asc, desc
from souk.plans import documents, reports
from souk.plans.rfm import CUSTOMER

BY_SPEND = (desc("monetary"), asc(CUSTOMER))
BY_RISK = (desc("churn_probability"), asc(CUSTOMER))
RADAR_FLOOR = 0.05


def _churned() -> Column:
    return rows_where(F.col("churn_prediction") == 1)


def _with_segment(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("segment_name") != "Unknown")


def _or_unknown(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("Unknown"))


# Overview


def kpi_overview(orders: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row of headline figures. Revenue here is price plus freight, not payments."""
    review = F.when(F.col("review_score") > 0, F.col("review_score"))
    return orders.agg(
        total("order_value").alias("order_revenue"),
        rows().alias("total_orders"),
        F.round(F.coalesce(mean_of_ratios(review), F.lit(0.0)), 2).alias("avg_review"),
    ).withColumns(
        {
            "total_customers": customers.agg(rows()).scalar(),
            "total_sellers": sellers.agg(rows()).scalar(),
        }
    )


def revenue_series(orders: DataFrame) -> DataFrame:
    month = month_of(F.col("order_purchase_timestamp")).alias("month")
    return (
        orders.groupBy(month)
        .agg(total("order_value").alias("order_revenue"), rows().alias("orders"))
        .filter(F.col("month").isNotNull())
        .orderBy("month")
    )


def converted(df: DataFrame, column: str, rate: float, name: str) -> DataFrame:
    return df.withColumn(name, F.round(F.col(column).cast("double") * F.lit(float(rate)), 2))


# Categories


def top20_categories(orders: DataFrame, size: int = 20, language: str = "vi") -> DataFrame:
    top = reports.top_categories(orders, size)
    return with_display_name(top, "main_category_english", "category", language).select(
        "category",
        rounded_or_zero("total_revenue").alias("revenue"),
        F.col("order_count").alias("total_sold"),
        rounded_or_zero("avg_order_value").alias("avg_price"),
        rounded_or_zero("avg_review_score").alias("avg_review"),
    )


def category_from_products(products: DataFrame, size: int = 20) -> DataFrame:
    return (
        products.groupBy("category_en")
        .agg(
            F.sum("total_orders").alias("total_sold"),
            F.sum(F.col("total_revenue").cast("decimal(38,2)")).cast("double").alias("revenue"),
            F.round(mean_of_ratios("avg_price"), 2).alias("avg_price"),
            F.round(mean_of_ratios("avg_review_score"), 2).alias("avg_review"),
        )
        .orderBy(F.desc("total_sold"), "category_en")
        .limit(size)
    )


def category_radar(categories: DataFrame, size: int = 5) -> DataFrame:
    """The top categories on a 0..100 scale per axis. The windows see ``size`` rows."""
    top = categories.orderBy(F.desc("revenue"), "category").limit(size)
    everything = Window.partitionBy()

    def scaled(column: str) -> Column:
        return percent(column, F.max(column).over(everything), 4)

    return top.select(
        "category",
        scaled("revenue").alias("revenue_axis"),
        scaled("total_sold").alias("sold_axis"),
        scaled("avg_price").alias("price_axis"),
        F.round(F.col("avg_review") * 20, 4).alias("review_axis"),
    )


def category_price_review(categories: DataFrame) -> DataFrame:
    return categories.filter((F.col("avg_price") != 0) & (F.col("avg_review") != 0)).select(
        "category", "avg_price", "avg_review"
    )


# Segments


def segment_distribution(customers: DataFrame) -> DataFrame:
    groups = customers.groupBy(_or_unknown("segment_name").alias("segment")).agg(rows().alias("customer_count"))
    return groups.orderBy(F.desc("customer_count"), "segment")


def rfm_sample(customers: DataFrame, size: int = 500) -> DataFrame:
    known = customers.filter(F.col("recency").isNotNull())
    return pick.hash_sample(
        known.select(CUSTOMER, F.col("segment_name").alias("segment"), "recency", "frequency", "monetary"),
        CUSTOMER,
        size,
    )


def customer_rows(customers: DataFrame, *extra: str) -> DataFrame:
    return customers.select(
        CUSTOMER,
        F.col("segment_name").alias("segment"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        "recency",
        "monetary",
        *extra,
    )


def top_customers(customers: DataFrame, size: int = 50) -> DataFrame:
    known = customers.filter(F.col("monetary").isNotNull())
    return customer_rows(known, "frequency").orderBy(*(k.sort() for k in BY_SPEND)).limit(size)


def segment_cohort_trend(customers: DataFrame) -> DataFrame:
    month = month_of(F.col("first_purchase_date")).alias("month")
    return (
        _with_segment(customers)
        .groupBy(month, F.col("segment_name").alias("segment"))
        .agg(rows().alias("customer_count"))
        .orderBy("month", "segment")
    )


def segment_month_matrix(customers: DataFrame, segments: Sequence[str] = labels.SEGMENTS) -> DataFrame:
    """First purchases per month, one column per segment; a month without any shows 0."""
    trend = segment_cohort_trend(customers)
    return (
        trend.groupBy("month").pivot("segment", list(segments)).agg(F.sum("customer_count")).na.fill(0).orderBy("month")
    )


def segment_revenue(customers: DataFrame) -> DataFrame:
    groups = _with_segment(customers).groupBy(F.col("segment_name").alias("segment"))
    return groups.agg(total("monetary").alias("revenue")).orderBy("segment")


def segment_radar(customers: DataFrame) -> DataFrame:
    """Segment averages relative to the largest segment average; low recency scores high."""
    stats = documents.segment_stats(_with_segment(customers))
    everything = Window.partitionBy()

    def relative(column: str) -> Column:
        return F.try_divide(F.col(column), F.max(column).over(everything))

    def floored(value: Column) -> Column:
        return F.round(F.greatest(F.lit(RADAR_FLOOR), value), 6)

    return stats.select(
        F.col("segment_name").alias("segment"),
        floored(1 - relative("avg_recency")).alias("recency_axis"),
        floored(relative("avg_frequency")).alias("frequency_axis"),
        floored(relative("avg_monetary")).alias("monetary_axis"),
    )


# Churn


def churn_rate(customers: DataFrame) -> DataFrame:
    return customers.agg(
        rows().alias("total"), _churned().alias("churned"), percent(_churned(), rows()).alias("churn_rate")
    )


def churn_by_segment(customers: DataFrame) -> DataFrame:
    groups = customers.groupBy(_or_unknown("segment_name").alias("segment")).agg(
        rows().alias("total"),
        _churned().alias("churned"),
        percent(_churned(), rows()).alias("churn_rate"),
        F.round(mean_of_ratios("churn_probability"), 2).alias("avg_probability"),
    )
    return groups.orderBy(F.desc("churned"), "segment")


def churn_by_state(customers: DataFrame, size: int = 5) -> DataFrame:
    groups = customers.groupBy(_or_unknown("customer_state").alias("state"))
    counted = groups.agg(rows().alias("total"), _churned().alias("churned"))
    return counted.orderBy(F.desc("churned"), "state").limit(size)


def _at_risk(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("churn_probability") > 0)


def _shown_with_risk(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "churn_probability": rounded_or_zero("churn_probability"),
            "monetary": rounded_or_zero("monetary"),
            "recency": F.coalesce(F.col("recency").cast("int"), F.lit(0)),
        }
    )


def high_risk_customers(customers: DataFrame, size: int = 10) -> DataFrame:
    shown = customer_rows(_at_risk(customers), "churn_probability")
    return _shown_with_risk(shown.orderBy(*(k.sort() for k in BY_RISK)).limit(size))


# Pages


def customers_page(customers: DataFrame, number: int = 1, size: int = 10, term: str = "") -> DataFrame:
    known = pick.search(customers.filter(F.col("monetary").isNotNull()), CUSTOMER, term)
    return pick.page(customer_rows(known, "frequency"), BY_SPEND, number, size)


def churn_page(customers: DataFrame, number: int = 1, size: int = 10, term: str = "") -> DataFrame:
    known = pick.search(_at_risk(customers), CUSTOMER, term)
    return _shown_with_risk(pick.page(customer_rows(known, "churn_probability"), BY_RISK, number, size))


def search_customers(customers: DataFrame, term: str) -> DataFrame:
    return customer_rows(pick.search(customers, CUSTOMER, term), "frequency")


def next_customers(customers: DataFrame, last_row: dict[str, Any], size: int, order: Sequence[Key] = BY_SPEND):
    """The page after ``last_row``, found by its sort key instead of by counting rows."""
    return pick.page_after(customer_rows(customers, "frequency"), order, last_row, size)


def customer_inputs(customers: DataFrame) -> DataFrame:
    """What the prediction form fills in; a value that is not known stays NULL."""
    return customers.select(
        CUSTOMER,
        "recency",
        "frequency",
        "monetary",
        F.col("avg_review_score").alias("review_score"),
        F.col("avg_delivery_days").alias("delivery_days"),
    )


def customer_lookup(customers: DataFrame, customer: Any) -> DataFrame:
    return customer_inputs(pick.lookup(customers, CUSTOMER, customer))


def latest_order_per_customer(orders: DataFrame) -> DataFrame:
    """The newest order of every customer; the newest of each partition is picked before the shuffle."""
    shown = {
        "price": "total_price",
        "freight_value": "total_freight_value",
        "delivery_days": "delivery_days",
        "item_count": "total_items",
        "installments": "max_installments",
    }
    fields = [F.col(source).alias(name) for name, source in shown.items()]
    newest = F.max(F.struct("order_purchase_timestamp", "order_id", *fields)).alias("newest")
    return orders.groupBy(CUSTOMER).agg(newest).select(CUSTOMER, "newest.*")


# Geography and reviews


def review_histogram(orders: DataFrame) -> DataFrame:
    scores = reports.reviewed(orders).groupBy(F.col("review_score").cast("int").alias("score"))
    return scores.agg(rows().alias("order_count")).orderBy("score")


def top_states(orders: DataFrame, size: int = 15) -> DataFrame:
    states = orders.groupBy("customer_state").agg(reports.revenue(), reports.order_count())
    return (
        states.orderBy(F.desc("total_revenue"), "customer_state")
        .limit(size)
        .select(
            _or_unknown("customer_state").alias("state"),
            F.col("total_revenue").alias("revenue"),
            F.col("order_count").alias("orders"),
        )
    )


def state_revenue_from_customers(customers: DataFrame, size: int = 15) -> DataFrame:
    states = customers.groupBy(_or_unknown("customer_state").alias("state"))
    counted = states.agg(rows().alias("customers"), total("monetary").alias("revenue"))
    return counted.orderBy(F.desc("customers"), "state").limit(size)


def payment_totals(orders: DataFrame) -> DataFrame:
    methods = orders.groupBy(_or_unknown("payment_type").alias("method"))
    counted = methods.agg(rows().alias("order_count"), total("total_payment_value").alias("total"))
    return counted.orderBy(F.desc("order_count"), "method")


def monday_first_heatmap(orders: DataFrame) -> DataFrame:
    """Cells by weekday (0 = Monday) and hour, as the heatmap draws them."""
    cells = reports.weekday_hour_heatmap(orders)
    return cells.select(
        monday_first(F.col("purchase_dayofweek")).alias("weekday"), F.col("purchase_hour").alias("hour"), "order_count"
    ).orderBy("weekday", "hour")


# Logistics


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("order_status") == "delivered") & F.col("delivery_days").isNotNull())


def logistics_kpis(orders: DataFrame) -> DataFrame:
    late = rows_where(F.col("delivery_status") == labels.LATE)
    return _delivered(orders).agg(
        F.round(mean("delivery_days"), 1).alias("avg_delivery_days"),
        F.round(mean_of_ratios("freight_ratio") * 100, 1).alias("avg_freight_pct"),
        rows().alias("total_delivered"),
        late.alias("total_late"),
        percent(late, rows(), 1).alias("late_rate"),
    )


def delivery_status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("delivery_status").agg(rows().alias("order_count")).orderBy("delivery_status")


def satisfaction_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("satisfaction_level").agg(rows().alias("order_count")).orderBy("satisfaction_level")


def state_delivery(orders: DataFrame, size: int = 10) -> DataFrame:
    """Delivery time in the states with the most delivered orders."""
    states = _delivered(orders).groupBy(F.col("customer_state").alias("state"))
    counted = states.agg(rows().alias("order_count"), F.round(mean("delivery_days"), 1).alias("avg_delivery_days"))
    return counted.orderBy(F.desc("order_count"), "state").limit(size)


def review_impact(orders: DataFrame) -> DataFrame:
    """Average score of punctual and of late orders, orders without a review included."""
    arrived = orders.filter(F.col("delivery_status").isin(labels.ON_TIME, labels.LATE))
    groups = arrived.groupBy("delivery_status").agg(F.round(mean_of_ratios("review_score"), 2).alias("avg_score"))
    return groups.orderBy("delivery_status")
