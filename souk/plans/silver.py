"""From eight tables to one clean, wide row per order.

Everything an order gets (customer, items, payments, reviews) is first aggregated to one row per order, then joined.

* The aggregates and the deduplicated orders share the partitioning on ``order_id``, so these joins add no shuffle and
  cannot fan out.
* An aggregate is unique on its grouping key, so Catalyst drops the join to any of them from a query that uses none of
  its columns. ``merged_orders_by_part`` is built that way, for single reports; ``merged_orders``, for all columns, reads
  each table as seldom as it can. ``written_orders`` has the same rows and sends the fewest bytes: only ids go to the
  lookups. It takes that plan where products, sellers and categories stand in their tables once.
* Sums, extremes and smallest-row picks combine map-side: an order that holds a third of the items reaches the shuffle
  as one row per task.
* Lookups in customers, products and sellers come before these aggregates, with a shuffle of their own on either side
  (if the dimension is not small enough to broadcast) and another after them. That is the form in which AQE splits a hot
  key, so a product in a third of the items does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions import dates, labels
from souk.functions.measures import mean, rows
from souk.operators.ordering import asc, nulls_last
from souk.operators.rows import first_per_key, one_row_per_key
from souk.sources.tables import BY_ORDER, Tables

PURCHASE_ORDER = ("order_purchase_timestamp", "customer_id", "order_status")
ITEM_ORDER = ("order_item_id", "product_id", "seller_id")
PRODUCT_AVERAGES = ("weight_g", "length_cm", "height_cm", "width_cm", "photos_qty")
AVERAGED = tuple(f"product_{p}" for p in PRODUCT_AVERAGES)

# What a missing value becomes in the clean table.
NUMBER_DEFAULTS = {
    "total_price": 0,
    "total_freight_value": 0,
    "total_payment_value": 0,
    "total_items": 0,
    "unique_products": 0,
    "unique_sellers": 0,
    "review_score": 0,
    "max_installments": 1,
    "payment_count": 0,
    "review_count": 0,
    "avg_product_weight_g": 0,
    "avg_product_length_cm": 0,
    "avg_product_height_cm": 0,
    "avg_product_width_cm": 0,
    "avg_product_photos_qty": 0,
}
TEXT_DEFAULTS = {
    "main_category_english": "unknown",
    "main_category": "desconhecido",
    "payment_type": "unknown",
    "review_comment_title": "",
    "review_comment_message": "",
    "seller_city": "unknown",
    "seller_state": "unknown",
}


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in defaults.items() if c in kinds}
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """The main payment type is that of the largest payment; equal payments are settled by the type's name."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("max_installments"),
        rows().alias("payment_count"),
        F.max(F.struct("payment_value", "payment_type")).getField("payment_type").alias("payment_type"),
        F.array_sort(F.collect_set("payment_type")).alias("payment_types_used"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Average score; text and date of the earliest review. Dated reviews come before undated ones."""
    earliest = F.min(
        F.struct(
            F.col("review_creation_date").isNull(),
            "review_creation_date",
            "review_id",
            "review_comment_title",
            "review_comment_message",
        )
    )
    taken = ["review_comment_title", "review_comment_message", "review_creation_date"]
    return reviews.groupBy("order_id").agg(
        mean("review_score").alias("review_score"),
        *(earliest.getField(c).alias(c) for c in taken),
        rows().alias("review_count"),
    )


def translated_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name. Spark broadcasts the translation if it is small and shuffles it
    otherwise."""
    return products.join(translation, "product_category_name", "left")


def seller_places(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix")


def items_enriched(tables: Tables) -> DataFrame:
    """Items with the columns of their product and seller."""
    products = translated_products(tables.products, tables.category_translation)
    return tables.order_items.join(products, "product_id", "left").join(
        seller_places(tables.sellers), "seller_id", "left"
    )


def item_totals(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("order_id").agg(
        rows().alias("total_items"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
    )


def item_averages(tables: Tables) -> DataFrame:
    """Mean weight, size and number of photos of an order's products."""
    names = [f"product_{p}" for p in PRODUCT_AVERAGES]
    items = tables.order_items.select("order_id", "product_id")
    joined = items.join(tables.products.select("product_id", *names), "product_id", "left")
    return joined.groupBy("order_id").agg(*(mean(n).alias(f"avg_{n}") for n in names))


def item_varieties(order_items: DataFrame) -> DataFrame:
    """Distinct counts are kept apart from the totals: Spark expands the rows once per distinct column, and here
    only the three ids are expanded."""
    return order_items.groupBy("order_id").agg(
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("seller_id").alias("unique_sellers"),
    )


def first_items(order_items: DataFrame) -> DataFrame:
    """Product and seller of each order's first item; an item without a number is the last."""
    first = F.min(F.struct(*nulls_last(ITEM_ORDER))).alias("first")
    return order_items.groupBy("order_id").agg(first).select("order_id", "first.product_id", "first.seller_id")


def first_categories(tables: Tables) -> DataFrame:
    products = translated_products(
        tables.products.select("product_id", "product_category_name"), tables.category_translation
    )
    found = first_items(tables.order_items).join(products, "product_id", "left")
    return one_row_per_key(
        found.select(
            "order_id",
            F.col("product_category_name_english").alias("main_category_english"),
            F.col("product_category_name").alias("main_category"),
        ),
        "order_id",
    )


def first_sellers(tables: Tables) -> DataFrame:
    found = first_items(tables.order_items).join(seller_places(tables.sellers), "seller_id", "left")
    return one_row_per_key(found.select("order_id", "seller_city", "seller_state"), "order_id")


def items_per_order(tables: Tables) -> DataFrame:
    """Totals, variety and product averages of an order's items; category and seller are those of its first item."""
    parts = (
        item_varieties(tables.order_items),
        first_categories(tables),
        first_sellers(tables),
        item_averages(tables),
    )
    joined = item_totals(tables.order_items)
    for part in parts:
        joined = joined.join(part, "order_id", "left")
    return joined


def dedup_orders(orders: DataFrame) -> DataFrame:
    """One row per order id: the earliest purchase. A copy without a date stays only if there is no other."""
    return first_per_key(orders, ["order_id"], [asc(c, nulls_last=True) for c in PURCHASE_ORDER])


def customers_per_order(tables: Tables) -> DataFrame:
    """Customer columns of each order, of the same row that ``dedup_orders`` keeps."""
    joined = tables.orders.select("order_id", *PURCHASE_ORDER).join(tables.customers, "customer_id", "left")
    columns = [c for c in tables.customers.columns if c != "customer_id"]
    kept = F.min(F.struct(*nulls_last(PURCHASE_ORDER), *columns)).alias("kept")
    return joined.groupBy("order_id").agg(kept).select("order_id", *(f"kept.{c}" for c in columns))


#: Columns of an order's first item that the order carries.
CARRIED = {
    "main_category_english": "product_category_name_english",
    "main_category": "product_category_name",
    "seller_city": "seller_city",
    "seller_state": "seller_state",
}


def items_with_facts(tables: Tables) -> DataFrame:
    """Items with what an order's row needs of their product and seller."""
    products = tables.products.select("product_id", "product_category_name", *AVERAGED)
    items = tables.order_items.select("order_id", *ITEM_ORDER, "price", "freight_value")
    return items.join(translated_products(products, tables.category_translation), "product_id", "left").join(
        seller_places(tables.sellers).drop("seller_zip_code_prefix"), "seller_id", "left"
    )


def facts_per_order(facts: DataFrame, varieties: DataFrame) -> DataFrame:
    """The columns of ``items_per_order`` from items with facts and from the distinct counts per order."""
    first = F.min(F.struct(*nulls_last(ITEM_ORDER), *CARRIED.values())).alias("first")
    sums = facts.groupBy("order_id").agg(
        rows().alias("total_items"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
        *(mean(n).alias(f"avg_{n}") for n in AVERAGED),
        first,
    )
    return sums.join(varieties, "order_id", "left").select(
        "order_id",
        "total_items",
        "total_price",
        "total_freight_value",
        "unique_products",
        "unique_sellers",
        *(F.col("first").getField(c).alias(name) for name, c in CARRIED.items()),
        *(f"avg_{n}" for n in AVERAGED),
    )


def items_per_order_once(tables: Tables) -> DataFrame:
    """The same columns as ``items_per_order`` from two scans of the items: one joined with products and sellers for
    all sums and the first item, one for the distinct counts."""
    return facts_per_order(items_with_facts(tables), item_varieties(tables.order_items))


def orders_with_customers(tables: Tables) -> DataFrame:
    """One row per order, as ``dedup_orders`` keeps it, with the columns of its customer."""
    joined = tables.orders.join(tables.customers, "customer_id", "left")
    ties = [c for c in tables.customers.columns if c != "customer_id"]
    kept = first_per_key(joined, ["order_id"], [asc(c, nulls_last=True) for c in (*PURCHASE_ORDER, *ties)])
    return kept.select(*tables.orders.columns, *ties)


def merged_orders(tables: Tables) -> DataFrame:
    """One row per order with customer, items, payments and reviews; 36 columns. Every raw table is read once, the items
    twice. ``merged_orders_by_part`` is for queries that use few of the columns, ``written_orders`` sends fewer bytes."""
    parts = (
        items_per_order_once(tables),
        payments_per_order(tables.payments),
        reviews_per_order(tables.reviews),
    )
    merged = orders_with_customers(tables)
    for part in parts:
        merged = merged.join(part, "order_id", "left")
    return merged


#: An order with more items than these is spread over tasks by ``merged_orders``.
LARGE_ORDER = 100_000

#: Keeps the rows of some orders, by a join on the order id.
Kept = Callable[[DataFrame], DataFrame]


def whole(df: DataFrame) -> DataFrame:
    return df


def suits_narrow_lookups(tables: Tables) -> bool:
    """Whether products, sellers and categories stand in their tables once, every order has an id, and none has more than
    ``LARGE_ORDER`` items. One job over the keys alone."""

    def more_than(n: int, df: DataFrame, key: str) -> DataFrame:
        counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(rows().alias("n"))
        return counted.filter(F.col("n") > n).select(F.lit(1).alias("found"))

    found = (
        more_than(1, tables.products, "product_id"),
        more_than(1, tables.sellers, "seller_id"),
        more_than(1, tables.category_translation, "product_category_name"),
        more_than(LARGE_ORDER, tables.order_items, "order_id"),
        tables.orders.filter(F.col("order_id").isNull()).select(F.lit(1).alias("found")),
    )
    return reduce(DataFrame.unionByName, found).agg(rows()).first()[0] == 0


def orders_by_customer_id(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The rows of ``orders_with_customers`` for orders that all have an id: only the two ids are sent to the customers.
    Of customers that come twice, the first row counts there, NULL behind all values."""
    columns = [c for c in customers.columns if c != "customer_id"]
    first = F.min(F.struct(*nulls_last(columns))).alias("first")
    once = customers.groupBy("customer_id").agg(first).select("customer_id", *(f"first.{c}" for c in columns))
    kept = dedup_orders(orders)
    found = kept.select("order_id", "customer_id").join(once, "customer_id", "left").drop("customer_id")
    return kept.join(found, "order_id", "left").select(*orders.columns, *columns)


def first_item_facts(tables: Tables, kept: Kept = whole) -> DataFrame:
    """Distinct counts of an order's items, category and seller of its first one. The items' ids are sent once, to their
    order; only the first ones go on to the lookups. An order has to suit a task."""
    ids = tables.order_items.filter(F.col("order_id").isNotNull()).select("order_id", *ITEM_ORDER)
    first = F.min(F.struct(*nulls_last(ITEM_ORDER))).alias("first")
    per_order = (
        kept(ids.repartition("order_id"))
        .groupBy("order_id")
        .agg(
            F.size(F.collect_set("product_id")).cast("long").alias("unique_products"),
            F.size(F.collect_set("seller_id")).cast("long").alias("unique_sellers"),
            first,
        )
        .select("order_id", "unique_products", "unique_sellers", "first.product_id", "first.seller_id")
    )
    categories = translated_products(
        tables.products.select("product_id", "product_category_name"), tables.category_translation
    )
    places = seller_places(tables.sellers).drop("seller_zip_code_prefix")
    found = per_order.join(categories, "product_id", "left").join(places, "seller_id", "left")
    carried = (F.col(c).alias(name) for name, c in CARRIED.items())
    return found.select("order_id", "unique_products", "unique_sellers", *carried)


def averages_by_order_id(tables: Tables) -> DataFrame:
    """The columns of ``item_averages``. Behind the lookup an order's items lie far apart and combine with few others, so
    they are sent as they are: sums and counts would be twice as wide."""
    items = tables.order_items.filter(F.col("order_id").isNotNull()).select("order_id", "product_id")
    found = items.join(tables.products.select("product_id", *AVERAGED), "product_id", "left").drop("product_id")
    return found.repartition("order_id").groupBy("order_id").agg(*(mean(n).alias(f"avg_{n}") for n in AVERAGED))


def narrow_orders(tables: Tables, kept: Kept = whole, few: bool = False) -> DataFrame:
    """The rows of ``merged_orders``, of the orders ``kept``, for tables that suit narrow lookups.

    Rows are kept where they lie by order id anyway. With ``few``, also sums and averages are: they would find no order,
    but if the ids are few enough to broadcast, Catalyst takes the join below the aggregates, down to the scans.
    """
    parts = (
        item_totals(tables.order_items),
        averages_by_order_id(tables),
        payments_per_order(tables.payments),
        reviews_per_order(tables.reviews),
    )
    totals, averages, payments, reviews = (kept(part) if few else part for part in parts)
    customers = [c for c in tables.customers.columns if c != "customer_id"]
    merged = orders_by_customer_id(kept(tables.orders), tables.customers)
    for part in (totals, first_item_facts(tables, kept), averages, payments, reviews):
        merged = merged.join(part, "order_id", "left")
    return merged.select(
        *tables.orders.columns,
        *customers,
        *totals.columns[1:],
        "unique_products",
        "unique_sellers",
        *CARRIED,
        *(c for part in (averages, payments, reviews) for c in part.columns[1:]),
    )


def written_orders(tables: Tables, kept: Kept = whole, few: bool = False) -> DataFrame:
    """The rows of ``merged_orders``, of the orders ``kept``, for all columns. One job looks at the keys first, since a
    product or seller that comes twice counts its items twice, which takes a lookup of every item."""
    if suits_narrow_lookups(tables):
        return narrow_orders(tables, kept, few)
    return merged_orders(replace(tables, **{name: kept(getattr(tables, name)) for name in BY_ORDER}))


def merged_orders_by_part(tables: Tables) -> DataFrame:
    """The same table as ``merged_orders`` from one aggregate per group of columns, so that Catalyst drops those that a
    query does not use."""
    parts = (
        customers_per_order(tables),
        items_per_order(tables),
        payments_per_order(tables.payments),
        reviews_per_order(tables.reviews),
    )
    merged = dedup_orders(tables.orders)
    for part in parts:
        merged = merged.join(part, "order_id", "left")
    return merged


def is_valid_order(status: Column, price: Column) -> Column:
    """A canceled order counts only if it has a price. An unknown status without a price does not count either."""
    return (status != "canceled") | (price > 0)


def clean_orders(merged: DataFrame) -> DataFrame:
    filled = with_defaults(merged, NUMBER_DEFAULTS | TEXT_DEFAULTS)
    return filled.filter(F.col("order_purchase_timestamp").isNotNull()).filter(
        is_valid_order(F.col("order_status"), F.col("total_price"))
    )


def order_features(cleaned: DataFrame) -> DataFrame:
    """Twelve columns computed row by row: delivery, freight, calendar and satisfaction."""
    purchased, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    early = dates.days_between(delivered, F.col("order_estimated_delivery_date"))
    price, freight = F.col("total_price"), F.col("total_freight_value")
    ratio = F.round(F.try_divide(freight.cast("double"), price.cast("double")), 4)
    with_amounts = cleaned.withColumns(
        {
            "delivery_days": dates.days_between(purchased, delivered),
            "estimated_vs_actual": early,
            "freight_ratio": F.when(price > 0, ratio).otherwise(0.0),
            "order_value": price + freight,
        }
    )
    return dates.with_calendar(with_amounts, "order_purchase_timestamp").withColumns(
        {
            "delivery_status": labels.delivery_status(early),
            "satisfaction_level": labels.satisfaction(F.col("review_score")),
        }
    )


def silver_orders(tables: Tables, kept: Kept = whole, few: bool = False) -> DataFrame:
    """The silver table of the orders ``kept``, which may be ``few``."""
    return order_features(clean_orders(written_orders(tables, kept, few)))


def with_parsed_timestamps(orders: DataFrame, columns: list[str]) -> DataFrame:
    return orders.withColumns({c: dates.parse_timestamp(c) for c in columns if c in orders.columns})
