"""The order table by narrow lookups: the same rows as the other plans, ids alone on the way to the lookups."""

import re
from dataclasses import replace

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_upkeep import rows_of

from souk import catalog
from souk.operators.staging import stage
from souk.plans import silver
from souk.sources import star


@pytest.fixture(scope="module")
def tables(spark):
    plain = star.from_star(spark, SF)
    return type(plain)(**{name: stage(df) for name, df in plain.items()})


@pytest.fixture
def no_broadcasts(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")
    for name, value in settings:
        spark.conf.set(name, value)
    yield
    for name, _ in settings:
        spark.conf.unset(name)


def exchanges(df):
    """Keys and columns of each exchange of the plan."""
    formatted = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    nodes = df._jdf.queryExecution().explainString(formatted)
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((.*?), \d+\)", nodes)
    plain = lambda names: [re.sub(r"#\d+L?$", "", n) for n in names.split(", ")]
    return [(plain(keys), plain(columns)) for columns, keys in found]


def odd(df, *columns):
    """Every seventh value of each column is missing, in other rows for each."""
    return df.withColumns(
        {c: F.when(F.pmod(F.xxhash64(F.lit(c), *df.columns), F.lit(7)) > 0, F.col(c)) for c in columns}
    )


@pytest.mark.parametrize("query", ["merged_orders", "clean_orders"])
def test_items_take_only_ids_to_the_lookups(spark, no_broadcasts, query):
    found = exchanges(catalog.run(query, spark, SF))
    lookups = [set(columns) for keys, columns in found if keys in (["product_id"], ["seller_id"])]
    assert {"order_id", "product_id"} in lookups
    assert not any({"price", "freight_value"} & columns for columns in lookups)
    assert {"order_id", *silver.ITEM_ORDER} in [set(columns) for _, columns in found]


def test_same_rows_as_the_other_plans(tables):
    assert silver.suits_narrow_lookups(tables)
    found = silver.narrow_orders(tables)
    assert found.columns == silver.merged_orders(tables).columns and found.dtypes == silver.merged_orders(tables).dtypes
    assert rows_of(found) == rows_of(silver.merged_orders(tables))


def test_missing_values_copies_and_repeated_customers(tables):
    """Copies of orders, items, payments and reviews; customers that come twice, unlike each other; ids that are missing."""
    orders = odd(tables.orders, "customer_id", "order_status", "order_purchase_timestamp")
    later = orders.withColumn("order_purchase_timestamp", F.expr("order_purchase_timestamp + interval 3 days"))
    items = odd(tables.order_items, "order_id", "order_item_id", "product_id", "seller_id", "price")
    payments, reviews = odd(tables.payments, "order_id", "payment_type"), odd(tables.reviews, "order_id", "review_id")
    others = tables.customers.withColumn("customer_city", F.lit("elsewhere")).withColumn("customer_state", F.lit(None).cast("string"))
    products = odd(tables.products, "product_category_name", "product_weight_g", "product_photos_qty")
    changed = replace(
        tables,
        orders=stage(orders.unionByName(later)),
        order_items=stage(items.unionByName(items.limit(500))),
        payments=stage(payments.unionByName(payments.limit(500))),
        reviews=stage(reviews.unionByName(reviews.limit(500))),
        customers=stage(odd(tables.customers, "customer_city").unionByName(others)),
        products=stage(products.filter("product_id % 5 > 0")),
        sellers=stage(odd(tables.sellers, "seller_city", "seller_state")),
    )
    assert silver.suits_narrow_lookups(changed)
    assert rows_of(silver.narrow_orders(changed)) == rows_of(silver.merged_orders(changed))


@pytest.mark.parametrize("name", ["products", "sellers", "category_translation"])
def test_repeated_lookup_rows_count_items_as_before(tables, name):
    few = getattr(tables, name).limit(2)
    twice = replace(tables, **{name: stage(getattr(tables, name).unionByName(few))})
    assert not silver.suits_narrow_lookups(twice)
    assert rows_of(silver.written_orders(twice)) == rows_of(silver.merged_orders(twice))


def test_large_orders_and_orders_without_id_take_the_other_plan(tables, monkeypatch):
    nameless = tables.orders.limit(1).withColumn("order_id", F.lit(None).cast("long"))
    one_more = replace(tables, orders=stage(tables.orders.unionByName(nameless)))
    assert not silver.suits_narrow_lookups(one_more)
    found = silver.written_orders(one_more)
    assert found.filter("order_id is null and customer_city is not null").count() == 1
    most = tables.order_items.groupBy("order_id").count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(silver, "LARGE_ORDER", most)
    assert silver.suits_narrow_lookups(tables)
    monkeypatch.setattr(silver, "LARGE_ORDER", most - 1)
    assert not silver.suits_narrow_lookups(tables)


def test_empty_tables(tables):
    empty = type(tables)(**{name: stage(df.limit(0)) for name, df in tables.items()})
    assert silver.written_orders(empty).count() == 0
    no_items = replace(tables, order_items=empty.order_items, payments=empty.payments, reviews=empty.reviews)
    assert rows_of(silver.written_orders(no_items)) == rows_of(silver.merged_orders(no_items))
