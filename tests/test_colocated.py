"""Tables in buckets of the order id: the same wide rows, no exchange, hot and missing ids."""

import threading
from dataclasses import replace

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_plans import plan
from test_ingestion import files_below
from test_upkeep import rows_of

from souk.plans import colocated, silver
from souk.sources import buckets, star


@pytest.fixture(scope="module")
def tables(spark):
    return star.from_star(spark, SF)


@pytest.fixture(scope="module")
def written(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("colocated"))
    colocated.write(tables, root, 8)
    return root


def test_no_exchange_for_joins_and_aggregates(spark, written):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(colocated.merged_orders(colocated.read(spark, written, 8)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text
    assert text.count("FileScan") == 6 and text.count("SelectedBucketsCount: 8 out of 8") == 6


def test_equal_to_the_unbucketed_plan(spark, tables, written):
    found = colocated.merged_orders(colocated.read(spark, written, 8))
    assert found.columns == silver.merged_orders(tables).columns
    assert rows_of(found) == rows_of(silver.merged_orders(tables))


def test_tables_are_written_at_the_same_time(spark, tables, tmp_path, monkeypatch):
    """All four have begun before any is done, and the failure of one is raised."""
    together, write = threading.Barrier(4, timeout=60), buckets.write

    def waiting(df, path, key, n_buckets):
        together.wait()
        if path.endswith("payments") and failing:
            raise OSError("disk")
        write(df, path, key, n_buckets)

    monkeypatch.setattr(buckets, "write", waiting)
    failing = False
    colocated.write(tables, str(tmp_path / "a"), 4)
    found = colocated.merged_orders(colocated.read(spark, str(tmp_path / "a"), 4))
    assert rows_of(found) == rows_of(silver.merged_orders(tables))
    failing = True
    with pytest.raises(OSError, match="disk"):
        colocated.write(tables, str(tmp_path / "b"), 4)


def test_no_table_names_stay(spark, written):
    colocated.read(spark, written, 8)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_hot_and_missing_order_ids(spark, tables, tmp_path):
    """A third of the items on one order, a third without any; writing the hot order takes more than one task."""
    hot = tables.orders.orderBy("order_id").first()["order_id"]
    spread = F.col("order_item_id") % 3
    items = tables.order_items.withColumn(
        "order_id", F.when(spread == 0, hot).when(spread == 1, F.lit(None)).otherwise(F.col("order_id"))
    )
    odd = replace(tables, order_items=items)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for large tables
    try:
        colocated.write(odd, str(tmp_path), 8)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = colocated.merged_orders(colocated.read(spark, str(tmp_path), 8))
    assert rows_of(found) == rows_of(silver.merged_orders(odd))
    hot_files = spark.read.parquet(f"{tmp_path}/facts").filter(F.col("order_id") == hot)
    assert hot_files.select(F.input_file_name()).distinct().count() > 1


def test_empty_tables_and_writing_again(spark, tables, tmp_path):
    path = str(tmp_path / "t")
    buckets.write(tables.payments, path, "order_id", 4)
    buckets.write(tables.payments.limit(0), path, "order_id", 4)
    assert buckets.read(spark, path, "order_id", 4).count() == 0
    assert buckets.read(spark, path, "order_id", 4).columns == tables.payments.columns
    buckets.write(tables.payments, path, "order_id", 4)
    assert buckets.read(spark, path, "order_id", 4).count() == tables.payments.count()
    assert len([f for f in files_below(path) if f.endswith(".parquet")]) <= 4 * buckets.SLICES


def test_odd_names_of_columns_and_folders(spark, tmp_path):
    path = str(tmp_path / "it's here")
    df = spark.range(10).select(F.col("id").alias("the key"), F.lit("x").alias("a`b"))
    buckets.write(df, path, "the key", 2)
    found = buckets.read(spark, path, "the key", 2)
    assert found.columns == ["the key", "a`b"] and found.count() == 10
    assert "Exchange" not in plan(found.groupBy("the key").count())
