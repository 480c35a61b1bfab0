"""Distinct customers and percentiles from sketches that are stored once per month and state and merged on demand.

A theta sketch answers how many different customers any set of months and states has, and how many two such sets share; a
KLL sketch answers percentiles of order values. Both merge without reading an order again, and their size depends on
their precision alone. Up to ``2 ** LG_ENTRIES`` customers a theta sketch is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.measures import rows
from souk.plans.rfm import CUSTOMER

MONTH, STATE = "purchase_year_month", "customer_state"
LG_ENTRIES = 12
KLL_SIZE = 400
#: Standard deviations, and normalised rank, by which an estimate may be off.
DEVIATIONS, RANK_ERROR = 4.0, 0.02
POINTS = (0.25, 0.5, 0.75)


def month_state_sketches(orders: DataFrame) -> DataFrame:
    """One row per month and state: orders, a sketch of the customers, and one of the order values."""
    return orders.groupBy(MONTH, STATE).agg(
        rows().alias("orders"),
        F.theta_sketch_agg(CUSTOMER, LG_ENTRIES).alias("customers"),
        F.kll_sketch_agg_double(F.col("order_value").cast("double"), KLL_SIZE).alias("order_values"),
    )


def merged_customers(sketches: DataFrame, *by: str) -> DataFrame:
    """One sketch per value of ``by`` (of the whole without it) from the stored ones."""
    return sketches.groupBy(*by).agg(F.sum("orders").alias("orders"), F.theta_union_agg("customers", LG_ENTRIES).alias("customers"))


def estimated_customers(sketches: DataFrame, *by: str) -> DataFrame:
    merged = merged_customers(sketches, *by)
    return merged.select(*by, "orders", F.theta_sketch_estimate("customers").alias("estimated_customers"))


def returning_customers(sketches: DataFrame) -> DataFrame:
    """Per month, about how many of its customers also bought in the previous month that is present. There is one row
    per month before the window."""
    months = merged_customers(sketches, MONTH)
    in_order = Window.orderBy(MONTH)
    pairs = months.withColumns({"previous": F.lag("customers").over(in_order), "previous_month": F.lag(MONTH).over(in_order)})
    both = F.theta_intersection("customers", "previous")
    either = F.theta_union("customers", "previous", LG_ENTRIES)
    return pairs.filter(F.col("previous").isNotNull()).select(
        MONTH,
        "previous_month",
        F.theta_sketch_estimate(both).alias("estimated_returning"),
        F.theta_sketch_estimate(either).alias("estimated_either"),
    )


def estimated_percentiles(sketches: DataFrame, *by: str, points: Sequence[float] = POINTS) -> DataFrame:
    """(by, point, value): percentiles of order values of each group of months and states."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("order_values", KLL_SIZE).alias("merged"))
    values = [
        F.struct(F.lit(p).alias("point"), F.kll_sketch_get_quantile_double("merged", F.lit(p)).alias("value")) for p in points
    ]
    return merged.select(*by, F.inline(F.array(*values)))


def near(estimate, exact, base=None):
    """Whether an estimated count is within the sketch's error, which for shared customers goes by the size of both sets."""
    bound = DEVIATIONS / (1 << LG_ENTRIES) ** 0.5 * (exact if base is None else base)
    return F.abs(estimate - exact) <= bound + 0.5


def checked_customers(orders: DataFrame, sketches: DataFrame) -> DataFrame:
    """(level, name, unique_customers, within_bound) by month, state and in all: the exact count, and whether the merged
    sketches come near it."""
    parts = []
    for level, by in (("month", (MONTH,)), ("state", (STATE,)), ("all", ())):
        name = (F.col(by[0]) if by else F.lit("all")).alias("name")
        exact = orders.groupBy(*by).agg(F.count_distinct(CUSTOMER).alias("unique_customers")).select(name, "unique_customers")
        about = estimated_customers(sketches, *by).select(name, "estimated_customers")
        within = near(F.col("estimated_customers"), F.col("unique_customers")).alias("within_bound")
        parts.append(exact.join(about, "name").select(F.lit(level).alias("level"), "name", "unique_customers", within))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def checked_returning(orders: DataFrame, sketches: DataFrame) -> DataFrame:
    """(month, returning_customers, within_bound): exact, and whether the intersected sketches come near it."""
    about = returning_customers(sketches)
    bought = orders.select(MONTH, CUSTOMER).filter(F.col(CUSTOMER).isNotNull()).distinct()
    earlier = bought.select(F.col(MONTH).alias("previous_month"), CUSTOMER)
    pairs = bought.join(about.select(MONTH, "previous_month"), MONTH)
    exact = pairs.join(earlier, ["previous_month", CUSTOMER], "left_semi").groupBy(MONTH).agg(rows().alias("n"))
    found = about.join(exact, MONTH, "left").withColumn("returning_customers", F.coalesce("n", F.lit(0).cast("long")))
    within = near(F.col("estimated_returning"), F.col("returning_customers"), F.col("estimated_either"))
    return found.select(MONTH, "returning_customers", within.alias("within_bound"))


def checked_percentiles(orders: DataFrame, sketches: DataFrame) -> DataFrame:
    """(state, point, orders, within_bound): whether the share of orders below the value, or up to it, is near the point."""
    value = F.col("order_value").cast("double")
    about = estimated_percentiles(sketches, STATE)
    ranked = orders.select(STATE, value.alias("own")).join(about, STATE).groupBy(STATE, "point").agg(
        rows().alias("orders"),
        F.count_if(F.col("own") < F.col("value")).alias("below"),
        F.count_if(F.col("own") <= F.col("value")).alias("upto"),
    )
    low, high = F.col("below") / F.col("orders"), F.col("upto") / F.col("orders")
    within = (low - RANK_ERROR <= F.col("point")) & (F.col("point") <= high + RANK_ERROR)
    return ranked.select(STATE, "point", "orders", within.alias("within_bound"))
