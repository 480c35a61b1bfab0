"""A star schema (orders, lineitem, customer, part, supplier, nation) seen as the eight marketplace tables.

The star schema has no reviews, payments or delivery dates, so these are derived from columns it has, by fixed
rules. They exercise the operators on real volumes; commercially they mean nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.dates import days_between
from souk.functions.labels import first_match
from souk.sources.tables import Tables

# The mapping of the stand-in.
STATUS = {"F": "delivered", "O": "shipped"}
OTHER_STATUS = "canceled"
REVIEW_SCORE = {"R": 1, "A": 3}
OTHER_SCORE = 5
UNTRANSLATED_CATEGORY = "Brand#13"
DELIVERY_CYCLE_DAYS, PROMISED_DAYS = 45, 25

# The columns used, so that opening a table starts no schema-inference job.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


def _mapped(column: str, names: dict, otherwise) -> Column:
    return first_match([(F.col(column) == key, value) for key, value in names.items()], otherwise)


def _decimal(column: str, precision: int) -> Column:
    return F.col(column).cast(f"decimal({precision},2)")


def order_lines(lineitem: DataFrame) -> DataFrame:
    """One line of an order, with DECIMAL amounts: products of decimals are exact, whatever the order of summing."""
    price, discount, tax = _decimal("l_extendedprice", 12), _decimal("l_discount", 4), _decimal("l_tax", 4)
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipped_at"),
        price.alias("price"),
        (price * tax).alias("freight_value"),
        (price * (1 - discount) * (1 + tax)).alias("payment_value"),
        F.concat("l_returnflag", "l_linestatus").alias("payment_type"),
        (F.col("l_quantity").cast("int") % 24 + 1).alias("payment_installments"),
        F.col("l_returnflag").alias("flag"),
        _mapped("l_returnflag", REVIEW_SCORE, OTHER_SCORE).alias("review_score"),
    )


def _orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    last_shipment = lines.groupBy(F.col("order_id").alias("shipped_order")).agg(F.max("shipped_at").alias("last_ship"))
    purchase = F.col("o_orderdate")
    days = F.pmod(days_between(purchase, F.col("last_ship")), F.lit(DELIVERY_CYCLE_DAYS))
    delivered = (F.col("o_orderstatus") == "F") & F.col("last_ship").isNotNull()
    return orders.join(last_shipment, F.col("o_orderkey") == F.col("shipped_order"), "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _mapped("o_orderstatus", STATUS, OTHER_STATUS).alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        purchase.alias("order_approved_at"),
        F.when(F.col("o_orderstatus").isin(*STATUS), F.date_add(purchase, 1).cast("timestamp_ntz")).alias(
            "order_delivered_carrier_date"
        ),
        F.when(delivered, F.date_add(purchase, days).cast("timestamp_ntz")).alias("order_delivered_customer_date"),
        F.date_add(purchase, PROMISED_DAYS).cast("timestamp_ntz").alias("order_estimated_delivery_date"),
    )


def from_star(spark: SparkSession, root: str) -> Tables:
    lines = order_lines(read(spark, root, "lineitem"))
    nation = read(spark, root, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    parts = read(spark, root, "part")
    size = F.col("p_size")
    category = F.col("p_brand")
    return Tables(
        orders=_orders(read(spark, root, "orders"), lines),
        order_items=lines.select(
            "order_id",
            F.col("line").alias("order_item_id"),
            "product_id",
            "seller_id",
            F.col("shipped_at").alias("shipping_limit_date"),
            "price",
            "freight_value",
        ),
        payments=lines.select(
            "order_id",
            F.col("line").alias("payment_sequential"),
            "payment_type",
            "payment_installments",
            "payment_value",
        ),
        reviews=lines.select(
            F.concat_ws("-", "order_id", "line").alias("review_id"),
            "order_id",
            "review_score",
            F.concat(F.lit("flag "), F.col("flag")).alias("review_comment_title"),
            F.concat_ws(" ", F.lit("part"), "product_id", F.lit("from"), "seller_id").alias("review_comment_message"),
            F.col("shipped_at").alias("review_creation_date"),
            F.col("shipped_at").alias("review_answer_timestamp"),
        ),
        customers=read(spark, root, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("state").alias("customer_state"),
        ),
        products=parts.select(
            F.col("p_partkey").alias("product_id"),
            category.alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length("p_brand").alias("product_description_lenght"),
            (size % 6).alias("product_photos_qty"),
            (size * 100).alias("product_weight_g"),
            size.alias("product_length_cm"),
            (size % 20 + 1).alias("product_height_cm"),
            (size % 30 + 1).alias("product_width_cm"),
        ),
        sellers=read(spark, root, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            F.col("state").alias("seller_state"),
        ),
        category_translation=parts.filter(category != UNTRANSLATED_CATEGORY)
        .select(category.alias("product_category_name"), F.lower(category).alias("product_category_name_english"))
        .distinct(),
    )


def purchases_from_events(spark: SparkSession, root: str) -> DataFrame:
    """The event stream as purchases, for the reports by hour and weekday (order dates are all midnight)."""
    return read(spark, root, "events").select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_unique_id"),
        F.col("ts").alias("order_purchase_timestamp"),
        _decimal("value", 12).alias("total_payment_value"),
    )
