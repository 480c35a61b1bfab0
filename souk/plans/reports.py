"""Reports on the silver order table and the customer scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.measures import mean, mean_of_ratios, percent, rows, rows_where, total, with_share
from souk.operators import distribution
from souk.operators.ranking import exact_percentiles

# The columns that the reports describe.
METRICS = (
    "total_price",
    "total_freight_value",
    "total_payment_value",
    "total_items",
    "delivery_days",
    "review_score",
    "freight_ratio",
    "order_value",
)
QUARTILES = (0.25, 0.5, 0.75)

def with_known_category(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("main_category_english") != "unknown")


# Measures of an order table, by the name they have in reports.


def order_count() -> Column:
    return rows().alias("order_count")


def revenue() -> Column:
    return total("total_payment_value").alias("total_revenue")


def customer_count() -> Column:
    return F.count_distinct("customer_unique_id").alias("unique_customers")


def review_mean() -> Column:
    return mean_of_ratios("review_score").alias("avg_review_score")


def delivery_mean() -> Column:
    return mean("delivery_days").alias("avg_delivery_days")


def payment_mean(name: str = "avg_order_value") -> Column:
    return mean("total_payment_value").alias(name)


def by(orders: DataFrame, keys: str | Sequence[str], *measures: Column) -> DataFrame:
    return orders.groupBy(*([keys] if isinstance(keys, str) else keys)).agg(*measures)


# Overview


def overview_summary(orders: DataFrame) -> DataFrame:
    return orders.agg(
        rows().alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("total_customers"),
        total("total_payment_value").alias("total_revenue"),
        F.round(mean("order_value"), 2).alias("avg_order_value"),
        F.min("order_purchase_timestamp").alias("date_range_start"),
        F.max("order_purchase_timestamp").alias("date_range_end"),
    )


def order_percentiles(orders: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    """Exact quartiles, one row per metric."""
    found = exact_percentiles(orders, columns, QUARTILES)
    quartiles = [(c, *(found[c][p] for p in QUARTILES)) for c in columns]
    table = orders.sparkSession.createDataFrame(quartiles, "measure string, p25 double, p50 double, p75 double")
    return table.withColumns({p: F.round(p, 6) for p in ("p25", "p50", "p75")})


def order_percentiles_approx(orders: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    return distribution.approx_percentiles(orders, columns, QUARTILES)


def order_percentiles_approx_ranks(orders: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    return distribution.approx_percentile_ranks(orders, columns, QUARTILES)


def describe_orders(orders: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    return distribution.describe(orders, columns)


# Groups of orders


def orders_by_status(orders: DataFrame) -> DataFrame:
    groups = by(orders, "order_status", order_count(), revenue(), review_mean())
    return with_share(groups, "order_count").orderBy(F.desc("order_count"), "order_status")


def monthly_revenue(orders: DataFrame) -> DataFrame:
    monthly = total("total_payment_value").alias("monthly_revenue")
    measures = (order_count(), monthly, customer_count(), review_mean(), delivery_mean())
    return by(orders, "purchase_year_month", *measures).orderBy("purchase_year_month")


def with_growth(months: DataFrame, value: str = "monthly_revenue", month: str = "purchase_year_month") -> DataFrame:
    """Growth over the previous month that is present. One row per month: the window sees a few hundred rows."""
    previous = F.lag(value).over(Window.orderBy(month))
    grown = months.withColumn("previous", previous)
    change = (F.col(value) - F.col("previous")) / F.nullif(F.col("previous"), F.lit(0.0)) * 100
    return grown.withColumn("mom_growth_pct", F.when(F.col("previous") > 0, F.round(change, 2))).drop("previous")


def monthly_revenue_growth(orders: DataFrame) -> DataFrame:
    return with_growth(monthly_revenue(orders)).orderBy("purchase_year_month")


def orders_by_state(orders: DataFrame) -> DataFrame:
    value = mean("order_value").alias("avg_order_value")
    measures = (order_count(), revenue(), customer_count(), review_mean(), delivery_mean(), value)
    groups = by(orders, "customer_state", *measures)
    return with_share(groups, "order_count").orderBy(F.desc("order_count"), "customer_state")


def payment_methods(orders: DataFrame) -> DataFrame:
    installments = mean("max_installments").alias("avg_installments")
    measures = (order_count(), revenue(), payment_mean("avg_payment_value"), installments, review_mean())
    groups = by(orders, "payment_type", *measures)
    return with_share(groups, "order_count").orderBy(F.desc("order_count"), "payment_type")


def installment_histogram(orders: DataFrame, method: str = "credit_card") -> DataFrame:
    paid = orders.filter(F.col("payment_type") == method)
    return by(paid, "max_installments", order_count(), payment_mean("avg_payment_value")).orderBy("max_installments")


# Reviews


def reviewed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("review_score") > 0)


def review_distribution(orders: DataFrame) -> DataFrame:
    """By whole score; an average of 4.5 counts as 4."""
    scored = reviewed(orders).withColumn("review_score", F.col("review_score").cast("int"))
    groups = by(
        scored,
        "review_score",
        rows().alias("review_count"),
        delivery_mean(),
        mean("order_value").alias("avg_order_value"),
        mean_of_ratios("freight_ratio").alias("avg_freight_ratio"),
    )
    return with_share(groups, "review_count").orderBy("review_score")


def review_average(orders: DataFrame) -> DataFrame:
    return reviewed(orders).agg(F.round(mean_of_ratios("review_score"), 2).alias("avg_score"))


def review_by_delivery_status(orders: DataFrame) -> DataFrame:
    groups = by(reviewed(orders), "delivery_status", rows().alias("review_count"), review_mean(), delivery_mean())
    return groups.orderBy(F.desc("avg_review_score"))


# Categories


def category_revenue(orders: DataFrame) -> DataFrame:
    return by(
        with_known_category(orders),
        "main_category_english",
        order_count(),
        revenue(),
        payment_mean("avg_order_value"),
        review_mean(),
        delivery_mean(),
        F.sum("total_items").alias("total_items_sold"),
        customer_count(),
    )


def top_categories(orders: DataFrame, size: int = 10) -> DataFrame:
    return category_revenue(orders).orderBy(F.desc("total_revenue"), "main_category_english").limit(size)


def bottom_categories(orders: DataFrame, size: int = 10) -> DataFrame:
    return category_revenue(orders).orderBy("total_revenue", "main_category_english").limit(size)


def category_count(orders: DataFrame) -> DataFrame:
    return with_known_category(orders).agg(F.count_distinct("main_category_english").alias("total_categories"))


def category_mean_review(orders: DataFrame) -> DataFrame:
    """Mean of the categories' mean scores, each category counting once."""
    groups = category_revenue(orders).filter(F.col("avg_review_score") > 0)
    return groups.agg(F.round(mean_of_ratios("avg_review_score"), 2).alias("avg_review"))


# Delivery


def delivered_in_days(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("order_status") == "delivered") & (F.col("delivery_days") >= 0))


def delivery_overall(orders: DataFrame) -> DataFrame:
    """Exact percentiles are safe here: the aggregate holds one counter per distinct number of days."""
    days = F.col("delivery_days")
    return delivered_in_days(orders).agg(
        F.round(mean(days), 2).alias("avg_delivery_days"),
        F.round(F.stddev_samp(days), 2).alias("std_delivery_days"),
        F.round(F.percentile(days, 0.5), 2).alias("median_delivery_days"),
        F.round(F.percentile(days, 0.95), 2).alias("p95_delivery_days"),
        F.min(days).alias("min_delivery_days"),
        F.max(days).alias("max_delivery_days"),
        percent(rows_where(F.col("estimated_vs_actual") >= 0), rows()).alias("on_time_rate_pct"),
    )


def delivery_buckets(orders: DataFrame) -> DataFrame:
    bucketed = delivered_in_days(orders).withColumn("delivery_bucket", labels.delivery_bucket(F.col("delivery_days")))
    slowest = F.max("delivery_days").alias("slowest")
    groups = with_share(by(bucketed, "delivery_bucket", order_count(), review_mean(), slowest), "order_count")
    return groups.orderBy("slowest").drop("slowest")


def delivery_by_state(orders: DataFrame) -> DataFrame:
    return by(
        delivered_in_days(orders),
        "customer_state",
        order_count(),
        delivery_mean(),
        F.percentile("delivery_days", 0.5).alias("median_delivery_days"),
        mean("estimated_vs_actual").alias("avg_estimated_vs_actual"),
    )


def slowest_states(orders: DataFrame, size: int = 10) -> DataFrame:
    return delivery_by_state(orders).orderBy(F.desc("avg_delivery_days"), "customer_state").limit(size)


# Time of purchase


def orders_by_hour(orders: DataFrame) -> DataFrame:
    return by(orders, "purchase_hour", order_count(), revenue()).orderBy("purchase_hour")


def orders_by_weekday(orders: DataFrame) -> DataFrame:
    return by(orders, "purchase_dayofweek", order_count(), revenue()).orderBy("purchase_dayofweek")


def weekday_hour_heatmap(orders: DataFrame) -> DataFrame:
    cells = ["purchase_dayofweek", "purchase_hour"]
    return by(orders, cells, order_count()).orderBy(*cells)


# Customers


def rfm_frequency_distribution(customers: DataFrame) -> DataFrame:
    return by(customers, "frequency", rows().alias("customer_count")).orderBy("frequency")


def rfm_score_distribution(scored: DataFrame) -> DataFrame:
    spend = mean("monetary").alias("avg_monetary")
    return by(scored, "rfm_score", rows().alias("customer_count"), spend).orderBy("rfm_score")


def repeat_customer_rate(customers: DataFrame) -> DataFrame:
    repeat = rows_where(F.col("frequency") > 1)
    return customers.agg(
        rows().alias("total_customers"),
        repeat.alias("repeat_customers"),
        percent(repeat, rows()).alias("repeat_customer_rate_pct"),
    )


def run(orders: DataFrame, scored: DataFrame) -> Mapping[str, DataFrame]:
    """Every report. ``orders`` and ``scored`` are best read from their written tables or persisted by the caller."""
    on_orders = {
        "overview_summary": overview_summary,
        "order_percentiles": order_percentiles_approx,
        "describe_order_metrics": describe_orders,
        "orders_by_status": orders_by_status,
        "orders_by_month": monthly_revenue_growth,
        "orders_by_state": orders_by_state,
        "review_distribution": review_distribution,
        "review_average": review_average,
        "review_by_delivery_status": review_by_delivery_status,
        "top_categories": top_categories,
        "bottom_categories": bottom_categories,
        "category_count": category_count,
        "payment_methods": payment_methods,
        "installment_histogram": installment_histogram,
        "delivery_overall": delivery_overall,
        "delivery_buckets": delivery_buckets,
        "delivery_by_state": delivery_by_state,
        "orders_by_hour": orders_by_hour,
        "orders_by_weekday": orders_by_weekday,
        "weekday_hour_heatmap": weekday_hour_heatmap,
    }
    on_customers = {
        "rfm_frequency_distribution": rfm_frequency_distribution,
        "rfm_score_distribution": rfm_score_distribution,
        "repeat_customer_rate": repeat_customer_rate,
    }
    return {name: report(orders) for name, report in on_orders.items()} | {
        name: report(scored) for name, report in on_customers.items()
    }
