"""Upkeep and buckets: rows of the orders kept, few bytes on the way, no shuffle files left."""

import glob
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_narrow_orders import exchanges, no_broadcasts, tables  # noqa: F401
from test_upkeep import rows_of

from souk.operators.staging import CLEANED, shuffles_freed
from souk.plans import colocated, silver
from souk.sources.tables import BY_ORDER


@pytest.fixture
def some(tables):  # noqa: F811
    return tables.orders.select("order_id").filter("order_id % 3 = 1")


@pytest.mark.parametrize(("kind", "few"), [("left_semi", True), ("left_anti", False)])
def test_only_the_orders_kept(tables, some, kind, few):  # noqa: F811
    def kept(df):
        return df.join(some, "order_id", kind)

    filtered = replace(tables, **{name: kept(getattr(tables, name)) for name in BY_ORDER})
    found = silver.narrow_orders(tables, kept, few)
    assert rows_of(found) == rows_of(silver.merged_orders(filtered))


def test_payments_and_reviews_are_summed_before_they_are_sent(tables, some, no_broadcasts):  # noqa: F811
    built = silver.silver_orders(tables, lambda df: df.join(some, "order_id", "left_semi"), few=True)
    sent = {c for keys, columns in exchanges(built) if keys == ["order_id"] for c in columns}
    assert not sent & {"payment_value", "review_comment_message", "price"}


def test_few_ids_reach_the_scans(spark, tables):  # noqa: F811
    few = spark.createDataFrame([(1,), (2,)], "order_id long")
    built = silver.silver_orders(tables, lambda df: df.join(F.broadcast(few), "order_id", "left_semi"), few=True)
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.count("LeftSemi")
    assert joined >= 5
    aggregates_below = [part for part in plan.split("Join LeftSemi")[1:] if part.lstrip(", ").split("\n")[1].lstrip(" +-:").startswith("Aggregate")]
    assert not aggregates_below


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    own = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for folder in own for f in glob.glob(f"{folder}/*/shuffle_*.data")}

    before, setting = files(), spark.conf.get(CLEANED, None)
    with shuffles_freed(spark):
        spark.range(1000).repartition(4).groupBy((F.col("id") % 10).alias("k")).count().write.parquet(f"{tmp_path}/t")
    until = time.time() + 20  # files go in the background
    while not files() <= before and time.time() < until:
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(CLEANED, None) == setting
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10


def test_bucketed_orders_take_only_ids_to_the_customers(tables, no_broadcasts):  # noqa: F811
    sent = [columns for keys, columns in exchanges(colocated.orders_to_write(tables)) if keys == ["customer_id"]]
    assert ["order_id", "customer_id"] in sent and not any("order_approved_at" in c for c in sent)
    nameless = tables.orders.limit(1).withColumn("order_id", F.lit(None).cast("long"))
    odd = replace(tables, orders=tables.orders.unionByName(nameless))
    for t in (tables, odd):
        assert rows_of(colocated.orders_to_write(t)) == rows_of(silver.orders_with_customers(t))


def test_buckets_grow_in_number_with_the_items(tables, monkeypatch):  # noqa: F811
    assert colocated.bucket_count(tables, 8) == 8
    monkeypatch.setattr(colocated, "BUCKET_ITEMS", 100)
    assert colocated.bucket_count(tables, 8) == -(-tables.order_items.count() // 100) > 8
