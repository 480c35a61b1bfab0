"""Orders, items, payments and reviews in buckets of the order id, and the wide order row from them without an exchange.

The exchanges on the order id are paid once, when the tables are written. After that, each of the aggregates per order and
the four-way join run bucket by bucket: nothing is sent between machines, whatever is computed per order. Customers,
products and sellers are looked up before writing, where AQE can split a hot product.

Items, payments and reviews without order id belong to no order and are left out here. One order is read by one task: its
rows stream through the aggregates, which keep only sums and the first item, its distinct ids, and its payment types.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.operators.staging import shuffles_freed
from souk.plans import silver
from souk.sources import buckets
from souk.sources.tables import Tables

KEY = "order_id"
#: So many items suit one task, which reads them three times, with their payments and reviews.
BUCKET_ITEMS = 400_000


@dataclass(frozen=True)
class OrderTables:
    """One row per order with its customer; items with product and seller facts; payments; reviews."""

    orders: DataFrame
    facts: DataFrame
    payments: DataFrame
    reviews: DataFrame


def bucket_count(tables: Tables, least: int) -> int:
    """``least`` buckets, or as many as keep each to about ``BUCKET_ITEMS`` items."""
    return max(least, -(-tables.order_items.count() // BUCKET_ITEMS))


def orders_to_write(tables: Tables) -> DataFrame:
    """One row per order with its customer. Only ids go to the customers, unless an order has none by which its customer
    could come back."""
    if tables.orders.filter(F.col(KEY).isNull()).isEmpty():
        return silver.orders_by_customer_id(tables.orders, tables.customers)
    return silver.orders_with_customers(tables)


def write(tables: Tables, root: str, n_buckets: int) -> None:
    """Write the four tables below ``root``, each in ``n_buckets`` buckets; a bucket should suit one task.

    The tables do not depend on each other and are written at the same time, so that the last tasks and the planning of
    one leave no cores idle. An executor runs no more tasks at once than before.
    """
    parts = {
        "orders": orders_to_write(tables),
        "facts": silver.items_with_facts(tables),
        "payments": tables.payments,
        "reviews": tables.reviews,
    }
    with shuffles_freed(tables.orders.sparkSession), ThreadPoolExecutor(len(parts)) as pool:
        running = []
        for name, df in parts.items():
            rows = df if name == "orders" else df.filter(F.col(KEY).isNotNull())
            one = inheritable_thread_target(df.sparkSession)(buckets.write)  # keeps the caller's job group and tags
            running.append(pool.submit(one, rows, f"{root}/{name}", KEY, n_buckets))
    for written in running:
        written.result()


def read(spark: SparkSession, root: str, n_buckets: int) -> OrderTables:
    names = ("orders", "facts", "payments", "reviews")
    return OrderTables(**{n: buckets.read(spark, f"{root}/{n}", KEY, n_buckets) for n in names})


def item_varieties(facts: DataFrame) -> DataFrame:
    """Distinct products and sellers, each from a scan of one column: expanding rows for both at once would lose the
    buckets."""
    products = facts.groupBy(KEY).agg(F.count_distinct("product_id").alias("unique_products"))
    sellers = facts.groupBy(KEY).agg(F.count_distinct("seller_id").alias("unique_sellers"))
    return products.join(sellers, KEY)


def merged_orders(tables: OrderTables) -> DataFrame:
    """The table of ``silver.merged_orders``, without any exchange."""
    merged = tables.orders
    for part in (
        silver.facts_per_order(tables.facts, item_varieties(tables.facts)),
        silver.payments_per_order(tables.payments),
        silver.reviews_per_order(tables.reviews),
    ):
        merged = merged.join(part, KEY, "left")
    return merged
