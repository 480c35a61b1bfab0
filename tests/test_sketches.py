"""Stored sketches merged over months and states, beyond the size up to which they are exact."""

import pytest
from pyspark.sql import functions as F

from souk.operators.staging import scope, stage
from souk.plans import sketches
from souk.plans.rfm import CUSTOMER


@pytest.fixture(scope="module")
def orders(spark):
    """60,000 customers a month, a third of them also in the next one; one state holds most orders."""
    return spark.range(240_000).select(
        (F.col("id") % 60_000 + F.floor(F.col("id") / 60_000) * 40_000).alias(CUSTOMER),
        F.concat(F.lit("2020-0"), (F.floor(F.col("id") / 60_000) + 1).cast("string")).alias(sketches.MONTH),
        F.when(F.col("id") % 9 < 7, "SP").when(F.col("id") % 9 == 7, "RJ").otherwise(F.lit(None)).alias(sketches.STATE),
        (F.col("id") * 7919 % 100_003 / 100).cast("decimal(12,2)").alias("order_value"),
    )


@pytest.fixture(scope="module")
def stored(spark, orders):
    return stage(sketches.month_state_sketches(orders))


def test_customers_of_any_set_of_months_and_states(orders, stored):
    found = sketches.checked_customers(orders, stored).collect()
    assert len(found) == 4 + 2 + 1 and all(r.within_bound for r in found)
    some = stored.filter("purchase_year_month in ('2020-02', '2020-04') and customer_state = 'SP'")
    about = sketches.estimated_customers(some).first()
    exact = orders.filter("purchase_year_month in ('2020-02', '2020-04') and customer_state = 'SP'")
    assert about["orders"] == exact.count()
    assert about["estimated_customers"] == pytest.approx(exact.select(CUSTOMER).distinct().count(), rel=0.06)
    assert about["estimated_customers"] != exact.select(CUSTOMER).distinct().count()  # no longer exact at this size


def test_returning_customers(orders, stored):
    found = {r[0]: r for r in sketches.checked_returning(orders, stored).collect()}
    assert sorted(found) == ["2020-02", "2020-03", "2020-04"]
    assert all(r.returning_customers == 20_000 and r.within_bound for r in found.values())


def test_percentiles_stay_within_the_rank_error(orders, stored):
    found = sketches.checked_percentiles(orders, stored).collect()
    assert len(found) == 2 * 3 and all(r.within_bound for r in found)
    whole = {r.point: r.value for r in sketches.estimated_percentiles(stored).collect()}
    assert [whole[p] for p in sketches.POINTS] == pytest.approx([250, 500, 750], abs=25)


def test_merging_reads_the_sketches_only(stored):
    plan = sketches.estimated_customers(stored, sketches.STATE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "order_value" not in plan.replace("order_values", "")


def test_a_wrong_estimate_is_noticed(spark):
    row = spark.range(1).select(
        sketches.near(F.lit(1000.0), F.lit(1000)).alias("a"),
        sketches.near(F.lit(1100.0), F.lit(1000)).alias("b"),
        sketches.near(F.lit(30.0), F.lit(20), F.lit(1000)).alias("c"),
    ).first()
    assert (row["a"], row["b"], row["c"]) == (True, False, True)


def test_no_orders(spark, orders):
    none = orders.limit(0)
    with scope(spark):
        stored = stage(sketches.month_state_sketches(none))
        assert sketches.estimated_customers(stored, sketches.MONTH).count() == 0
        assert sketches.returning_customers(stored).count() == 0
        assert sketches.checked_percentiles(none, stored).count() == 0
