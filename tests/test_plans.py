"""Plan shapes that matter at scale."""

import os
import re
from dataclasses import replace

import pytest
from conftest import SF
from pyspark.sql import functions as F

from souk import catalog
from souk.operators.staging import scope, shared_folder, stage
from souk.plans import dashboard, documents, reports, rfm, silver
from souk.sources import star

LARGER = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["merged_orders", "monthly_revenue_growth", "product_stats", "seller_stats", "customer_documents"]
)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalog.run(name, spark, SF))
    assert not re.search(r"Python|Pandas|Arrow", text)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_unused_children_disappear(shop):
    text = plan(reports.orders_by_status(shop.orders))
    assert "customer.parquet" not in text
    assert "part.parquet" not in text and "supplier.parquet" not in text
    assert text.count("lineitem.parquet") == 3


def test_scan_reads_only_what_is_used(shop):
    text = plan(shop.tables.payments.groupBy("payment_type").agg(F.max("payment_installments")))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(part.split(":")[0] for part in schema.split(",")) == {"l_returnflag", "l_linestatus", "l_quantity"}


def test_lookup_filter_reaches_the_scan(shop, spark, tmp_path):
    path = str(tmp_path / "customers")
    shop.customers.write.parquet(path)
    text = plan(dashboard.customer_lookup(spark.read.parquet(path), 42))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(customer_unique_id,42\)", text)


def test_children_join_without_another_shuffle(spark, shop):
    """With broadcast joins off, as for large inputs: one exchange for each aggregate, none for the joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = shop.tables.orders.select("order_id", "order_purchase_timestamp", "customer_id", "order_status")
        joined = (
            silver.dedup_orders(orders)
            .join(silver.payments_per_order(shop.tables.payments), "order_id", "left")
            .join(silver.reviews_per_order(shop.tables.reviews), "order_id", "left")
        ).select("order_id", "order_status", "total_payment_value", "review_score")
        text = plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 3


def test_written_orders_read_each_table_as_seldom_as_they_can(spark, shop):
    """Over plain tables with broadcasts off: items twice, all else once, and at most half of the 28 exchanges that the
    plan by parts has over the stand-in."""
    tables = type(shop.tables)(**{name: stage(df) for name, df in shop.tables.items()})
    settings = ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")
    for name, value in settings:
        spark.conf.set(name, value)
    try:
        text = plan(silver.merged_orders(tables))
        by_part = plan(silver.merged_orders_by_part(tables))
    finally:
        for name, _ in settings:
            spark.conf.unset(name)
    for name, df in tables.items():
        scans = re.findall(rf"FileScan.*{os.path.basename(df.inputFiles()[0].rsplit('/', 1)[0])}", text)
        assert len(scans) == (2 if name == "order_items" else 1), name
    assert text.count("Exchange hashpartitioning") <= 14 < by_part.count("Exchange hashpartitioning")


def test_both_plans_of_the_order_table_agree(shop):
    once, by_part = silver.merged_orders(shop.tables), silver.merged_orders_by_part(shop.tables)
    assert sorted(once.columns) == sorted(by_part.columns)
    assert once.exceptAll(by_part.select(*once.columns)).count() == 0 and once.count() == by_part.count()


def test_top_k_does_not_sort_everything(shop):
    assert "TakeOrderedAndProject" in plan(dashboard.top_customers(shop.customers))


def test_hot_keys_give_whole_results(spark, shop):
    """One order holds a third of the items, one product another third."""
    items = shop.tables.order_items
    hot = items.withColumns(
        {
            "order_id": F.when(F.col("price") < 35000, F.lit(1)).otherwise(F.col("order_id")).cast("long"),
            "product_id": F.when(F.col("price") > 70000, F.lit(3)).otherwise(F.col("product_id")).cast("long"),
        }
    )
    assert documents.product_sales(hot).agg(F.sum("total_orders")).first()[0] == items.count()
    expected = hot.filter("order_id = 1").agg(F.count_distinct("product_id")).first()[0]
    assert silver.item_varieties(hot).filter("order_id = 1").first()["unique_products"] == expected


@pytest.fixture
def large_data_settings(spark):
    """Thresholds lowered so that the test data counts as large: no broadcasts, small skewed partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def splits_a_hot_key(df):
    df.collect()
    return "skew=true" in plan(df)


def test_aqe_splits_hot_products_orders_and_customers(spark, large_data_settings):
    tables = star.from_star(spark, LARGER)
    a_third = F.col("price") < 35000
    items = tables.order_items.repartition(16)
    hot_product = items.withColumn("product_id", F.when(a_third, 3).otherwise(F.col("product_id")).cast("long"))
    assert splits_a_hot_key(silver.item_averages(replace(tables, order_items=hot_product)))

    orders = silver.silver_orders(tables)
    written = stage(orders)
    hot_order = items.withColumn("order_id", F.when(a_third, 3).otherwise(F.col("order_id")).cast("long"))
    assert splits_a_hot_key(documents.product_reviews(written, hot_order))

    scored = stage(rfm.rfm_scores(written))
    hot_customer = written.repartition(16).withColumn(
        "customer_unique_id", F.when(F.col("order_id") % 3 == 0, 5).otherwise(F.col("customer_unique_id")).cast("long")
    )
    joined = rfm.orders_with_rfm(hot_customer, scored)
    assert splits_a_hot_key(joined.agg(F.max(F.struct("order_id", "review_comment_message", "monetary"))))


class FakeSession:
    """Just the settings the staging folder is chosen by."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_staged_tables_go_to_the_named_folder():
    assert shared_folder(FakeSession("hdfs://shared", "yarn")) == "hdfs://shared"
    assert shared_folder(FakeSession("/shared", "local[8]")) == "/shared"


def test_a_cluster_does_not_share_a_local_folder():
    for folder in ("file:/tmp/x", "file:///tmp/x"):
        with pytest.raises(RuntimeError, match="not share"):
            shared_folder(FakeSession(folder, "yarn"))
        assert shared_folder(FakeSession(folder, "local-cluster[2,1,1024]")) == folder


def test_staged_tables_go_at_the_end_of_their_scope(spark):
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    with scope(spark):
        assert stage(spark.range(5)).count() == 5
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_no_temporary_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession(None, "yarn"))
    local = FakeSession(None, "local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder


def test_customer_figures_read_the_raw_tables_once(spark):
    from souk.catalog import Shop

    shop = Shop(spark, SF)
    for table in (shop.scored, shop.features, shop.customer_documents):
        assert not [path for path in table.inputFiles() if path.startswith(f"file://{SF}")]
    assert shop.scored.count() == shop.rfm.count()


def test_summary_columns_come_from_the_plan_by_parts(spark):
    from souk.catalog import Shop

    shop = Shop(spark, SF)
    written = shop.written
    assert "wide" not in shop.__dict__ and "merged" not in shop.__dict__
    wide = shop.wide.select(*written.columns)
    assert written.exceptAll(wide).count() == 0 and written.count() == wide.count()
