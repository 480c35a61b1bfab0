"""The silver table brought up to date by month against building it anew, and the area under the curve by ranks."""

import os
from dataclasses import replace

import pytest
from conftest import SF
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F
from test_ingestion import files_below, later

from souk.models import evaluation
from souk.plans import lakehouse, silver, upkeep
from souk.sources import raw_csv, star


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


@pytest.fixture(scope="module")
def tables(spark):
    return star.from_star(spark, SF)


def months_with_files(path):
    found = {}
    for f in files_below(path):
        month = os.path.basename(os.path.dirname(f))
        found.setdefault(month, set()).add(os.path.basename(f))
    return found


def test_changed_orders_rebuild_their_months_only(spark, tables, tmp_path):
    path = str(tmp_path / "silver")
    upkeep.write_by_month(silver.silver_orders(tables), path)
    before = months_with_files(path)
    first = tables.orders.orderBy("order_purchase_timestamp", "order_id").first()
    moved = tables.orders.withColumn(
        "order_purchase_timestamp",
        F.when(F.col("order_id") == first["order_id"], F.col("order_purchase_timestamp") + F.expr("interval 400 days"))
        .otherwise(F.col("order_purchase_timestamp")),
    )
    second = tables.orders.filter(F.col("order_id") != first["order_id"]).orderBy(F.desc("order_purchase_timestamp")).first()
    changed = replace(
        tables, orders=moved, order_items=tables.order_items.filter(F.col("order_id") != second["order_id"])
    )
    ids = spark.createDataFrame([(first["order_id"],), (second["order_id"],), (-5,)], "order_id long")
    months = upkeep.refresh(spark, changed, path, ids)
    moments = [first["order_purchase_timestamp"], second["order_purchase_timestamp"]]
    assert {f"m{m:%Y-%m}" for m in moments} <= set(months) and len(months) == 3
    assert rows_of(upkeep.read_by_month(spark, path)) == rows_of(silver.silver_orders(changed))
    after = months_with_files(path)
    same = {m for m in before if m.removeprefix("_month=") not in months}
    assert len(same) > 12 and all(before[m] == after[m] for m in same)
    assert all(before[m] != after.get(m) for m in before if m not in same)


def test_a_month_without_orders_goes(spark, tables, tmp_path):
    path = str(tmp_path / "silver")
    upkeep.write_by_month(silver.silver_orders(tables), path)
    last = max(months_with_files(path)).removeprefix("_month=")
    gone = tables.orders.filter(upkeep.month_key() == last)
    left = replace(tables, orders=tables.orders.join(gone, "order_id", "left_anti"))
    assert upkeep.refresh(spark, left, path, gone) == [last]
    assert f"_month={last}" not in months_with_files(path)
    assert rows_of(upkeep.read_by_month(spark, path)) == rows_of(silver.silver_orders(left))
    assert upkeep.refresh(spark, left, path, gone) == []


def test_orders_given_twice_in_two_months(spark, tables, tmp_path):
    path = str(tmp_path / "silver")
    upkeep.write_by_month(silver.silver_orders(tables), path)
    some = tables.orders.orderBy(F.desc("order_purchase_timestamp"), "order_id").limit(3)
    copies = some.withColumn("order_purchase_timestamp", F.col("order_purchase_timestamp") - F.expr("interval 200 days"))
    twice = replace(tables, orders=tables.orders.unionByName(copies))
    upkeep.refresh(spark, twice, path, some)
    assert rows_of(upkeep.read_by_month(spark, path)) == rows_of(silver.silver_orders(twice))


def test_update_of_a_lakehouse(spark, tables, tmp_path):
    """New files with orders and items touch some months; a new customer file has everything built."""
    raw = raw_csv.table_paths(str(tmp_path / "raw"))
    layout = lakehouse.Layout(str(tmp_path / "lake"))
    late = tables.orders.filter("order_id % 50 = 1").select("order_id")
    for name, df in tables.items():
        kinds = dict(df.dtypes)
        text = df.select(
            *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if "timestamp" in kinds[c] else c for c in df.columns)
        )
        first = text.join(late, "order_id", "left_anti") if name in upkeep.BY_ORDER else text
        first.select(df.columns).coalesce(1).write.option("header", True).csv(raw[name])
        if name in upkeep.BY_ORDER:
            rest = text.join(late, "order_id", "left_semi").select(df.columns)
            rest.coalesce(1).write.option("header", True).csv(f"{tmp_path}/rest/{name}")
    assert lakehouse.update(spark, raw, layout) is None
    untouched = months_with_files(layout.orders_base)
    assert lakehouse.update(spark, raw, layout) == []
    assert months_with_files(layout.orders_base) == untouched

    for name in upkeep.BY_ORDER:
        found = [f for f in os.listdir(tmp_path / "rest" / name) if f.endswith(".csv")]
        os.rename(tmp_path / "rest" / name / found[0], f"{raw[name]}/rest.csv")
    months = lakehouse.update(spark, raw, layout)
    assert 0 < len(months) < len(untouched)
    after = months_with_files(layout.orders_base)
    assert all(after[m] == untouched[m] for m in untouched if m.removeprefix("_month=") not in months)
    whole = lakehouse.Layout(str(tmp_path / "whole"))
    lakehouse.ingest(spark, raw, whole)
    lakehouse.build_silver(spark, whole)
    for a, b in ((layout.silver_orders, whole.silver_orders), (layout.gold("rfm_customers"), whole.gold("rfm_customers"))):
        assert rows_of(spark.read.parquet(a)) == rows_of(spark.read.parquet(b))

    customer_file = next(f for f in os.listdir(raw["customers"]) if f.endswith(".csv"))
    later(os.path.join(raw["customers"], customer_file))
    assert lakehouse.update(spark, raw, layout) is None


def test_area_by_ranks_is_that_of_the_evaluator(spark):
    df = spark.range(5000).selectExpr(
        "cast(id % 3 = 0 and id % 7 > 1 as double) label", "cast((id * 7919) % 613 as double) + (id % 3) * 40 rawPrediction"
    ).repartition(7)
    found = evaluation.rank_area(df).first()
    wanted = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0).evaluate(df)
    assert found["auc"] == pytest.approx(wanted, abs=1e-9) and found["rows_scored"] == 5000
    plan = evaluation.rank_area(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Window")[-1]


def test_area_without_a_class(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "label double, rawPrediction double")
    assert evaluation.rank_area(df).first()["auc"] is None
    assert evaluation.rank_area(df.limit(0)).first()["rows_scored"] == 0
