"""Edge cases of the silver table, the customer scores and the reports, on hand-made rows."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.plans import churn, dashboard, documents, reports, rfm, silver
from souk.sources.contracts import CONTRACTS
from souk.sources.tables import Tables


def at(day, hour=0):
    return datetime(2018, 1, day, hour)


def table(spark, name, rows=()):
    contract = CONTRACTS[name]
    names = contract.schema.names
    full = [tuple(row.get(c) for c in names) for row in rows]
    return spark.createDataFrame(full, contract.schema)


def order(key, customer="c1", status="delivered", bought=None, arrived=None, promised=None):
    return {
        "order_id": key,
        "customer_id": customer,
        "order_status": status,
        "order_purchase_timestamp": at(1) if bought is None else bought,
        "order_delivered_customer_date": arrived,
        "order_estimated_delivery_date": promised,
    }


def item(key, number=1, product="p1", seller="s1", price="10.00", freight="2.50"):
    return {
        "order_id": key,
        "order_item_id": number,
        "product_id": product,
        "seller_id": seller,
        "price": Decimal(price),
        "freight_value": Decimal(freight),
    }


def pay(key, value, kind="credit_card", parts=1):
    return {
        "order_id": key,
        "payment_type": kind,
        "payment_installments": parts,
        "payment_value": Decimal(value),
    }


def review(key, score, number="r1", day=5, title=None):
    return {
        "review_id": number,
        "order_id": key,
        "review_score": score,
        "review_comment_title": title,
        "review_creation_date": at(day),
    }


def tables(spark, **rows):
    base = {
        "customers": [
            {"customer_id": c, "customer_unique_id": f"u{c}", "customer_city": "x", "customer_state": "SP"}
            for c in ("c1", "c2")
        ],
        "products": [
            {"product_id": "p1", "product_category_name": "casa", "product_weight_g": 100},
            {"product_id": "p2", "product_category_name": "sem", "product_weight_g": 300},
        ],
        "sellers": [{"seller_id": "s1", "seller_city": "rio", "seller_state": "RJ"}],
        "category_translation": [{"product_category_name": "casa", "product_category_name_english": "home_appliances"}],
    } | rows
    return Tables(**{n: table(spark, n, base.get(n, ())) for n in Tables.__dataclass_fields__})


def by_id(df, key="order_id"):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def orders(spark):
    t = tables(
        spark,
        orders=[
            order("on_time", bought=at(1, 23), arrived=at(5, 1), promised=at(5)),
            order("late", arrived=at(9), promised=at(5)),
            order("not_arrived", promised=at(5)),
            order("canceled_free", status="canceled"),
            order("canceled_paid", status="canceled"),
            order("no_status_free", status=None),
            order("no_status_paid", status=None),
            order("free_item"),
            order("other", customer="c2", status="shipped"),
            order("unknown_customer", customer="c9"),
            order("on_time", bought=at(3)),
            {"order_id": "never_bought", "customer_id": "c1", "order_status": "delivered"},
        ],
        order_items=[
            item("on_time", 2, "p1", "s1"),
            item("on_time", 1, "p2", "s9", "30.00"),
            item("late"),
            item("canceled_paid"),
            item("no_status_paid"),
            item("free_item", price="0.00"),
        ],
        payments=[
            pay("on_time", "5.00", "voucher", 1),
            pay("on_time", "40.00", "credit_card", 3),
            pay("late", "6.00", "boleto"),
            pay("late", "6.00", "voucher"),
        ],
        reviews=[
            review("on_time", 3, "r2", 7, "second"),
            review("on_time", 4, "r1", 6, "first"),
            review("late", 4, "r3"),
            review("late", 5, "r4"),
        ],
    )
    written = silver.silver_orders(t).persist()
    yield written
    written.unpersist()


@pytest.fixture(scope="module")
def rows(orders):
    return by_id(orders)


def test_which_orders_remain(rows):
    assert set(rows) == {
        "on_time",
        "late",
        "not_arrived",
        "canceled_paid",
        "no_status_paid",
        "free_item",
        "other",
        "unknown_customer",
    }


def test_duplicate_order_keeps_the_earliest_purchase(rows):
    assert rows["on_time"]["order_purchase_timestamp"] == at(1, 23)


def test_first_item_gives_category_and_seller(rows):
    row = rows["on_time"]
    assert (row["main_category"], row["main_category_english"]) == ("sem", "unknown")
    assert (row["seller_city"], row["seller_state"]) == ("unknown", "unknown")
    assert (row["total_items"], row["unique_products"], row["unique_sellers"]) == (2, 2, 2)
    assert row["avg_product_weight_g"] == 200.0


def test_main_payment_is_the_largest_then_by_name(rows):
    assert rows["on_time"]["payment_type"] == "credit_card"
    assert rows["on_time"]["payment_types_used"] == ["credit_card", "voucher"]
    assert rows["on_time"]["max_installments"] == 3
    assert rows["late"]["payment_type"] == "voucher"
    assert rows["other"]["payment_type"] == "unknown"
    assert rows["other"]["max_installments"] == 1


def test_reviews(rows):
    assert rows["on_time"]["review_score"] == 3.5
    assert rows["on_time"]["satisfaction_level"] == "dissatisfied"
    assert rows["on_time"]["review_comment_title"] == "first"
    assert rows["late"]["satisfaction_level"] == "satisfied"
    assert (rows["other"]["review_score"], rows["other"]["satisfaction_level"]) == (0.0, "no_review")


def test_delivery_counts_calendar_days(rows):
    assert rows["on_time"]["delivery_days"] == 4
    assert (rows["on_time"]["estimated_vs_actual"], rows["on_time"]["delivery_status"]) == (0, "on_time")
    assert (rows["late"]["estimated_vs_actual"], rows["late"]["delivery_status"]) == (-4, "late")
    assert rows["not_arrived"]["delivery_status"] == "not_delivered"
    assert rows["not_arrived"]["delivery_days"] is None


def test_freight_ratio(rows):
    assert rows["late"]["freight_ratio"] == 0.25
    assert rows["free_item"]["freight_ratio"] == 0.0
    assert rows["late"]["order_value"] == Decimal("12.50")


def test_unknown_customer_keeps_its_order(rows):
    assert rows["unknown_customer"]["customer_unique_id"] is None


def test_customers_without_delivered_orders(orders):
    scored = rfm.rfm_scores(orders)
    assert "uc2" not in by_id(scored, "customer_unique_id")
    joined = by_id(rfm.orders_with_rfm(orders, scored))
    assert len(joined["other"]) == 59
    assert joined["other"]["recency"] is None
    assert joined["other"]["churn"] == 0


def test_fewer_customers_than_quartiles(orders):
    """Orders without a customer are nobody's: they take no place in the quartiles."""
    scored = rfm.rfm_scores(orders).collect()
    assert [(r["r_score"], r["f_score"], r["m_score"], r["rfm_score"]) for r in scored] == [(1, 1, 1, 3)]


def test_review_buckets_truncate(orders):
    found = {r["review_score"]: r["review_count"] for r in reports.review_distribution(orders).collect()}
    assert found == {3: 1, 4: 1}


def test_growth_skips_gaps_and_zero_months(spark):
    months = spark.createDataFrame(
        [("2016-09", 0.0), ("2016-10", 50.0), ("2016-12", 75.0)], "purchase_year_month string, monthly_revenue double"
    )
    found = [r["mom_growth_pct"] for r in reports.with_growth(months).orderBy("purchase_year_month").collect()]
    assert found == [None, None, 50.0]


def test_order_documents_are_nested(orders):
    document = by_id(documents.order_documents(orders))["late"]
    assert document["customer"]["customer_unique_id"] == "uc1"
    assert document["items"]["category"] == "home_appliances"
    assert document["payment"]["installments"] == 1
    assert document["review"]["satisfaction_level"] == "satisfied"


def test_customer_documents_without_segments_and_predictions(orders):
    found = documents.customer_documents(rfm.rfm_scores(orders)).first()
    assert (found["segment_name"], found["cluster"], found["churn_probability"]) == ("Unknown", None, 0.0)


def test_search_takes_the_term_literally(spark):
    people = spark.createDataFrame([("a.c",), ("abc",), ("A.C2",)], "customer_unique_id string")
    from souk.operators.rows import search

    assert sorted(r[0] for r in search(people, "customer_unique_id", "a.C").collect()) == ["A.C2", "a.c"]


def test_equal_values_scale_to_zero(spark):
    same = spark.createDataFrame(
        [(i, 5, 1, 10.0, 4.0, 7.0) for i in range(3)],
        "customer_unique_id int, recency int, frequency int, monetary double, avg_review_score double, "
        "avg_delivery_days double",
    )
    assert {r["risk"] for r in churn.minmax_risk(same).collect()} == {0.5}


def test_training_risk_may_leave_the_unit_range_only_on_review(spark):
    features = spark.createDataFrame(
        [("no review", 0, 1, 0.0, 0.0, 0.0), ("extreme", 9999, 99, 1e9, 1.0, 999.0)],
        "customer_unique_id string, recency int, frequency int, monetary double, avg_review double, "
        "avg_delivery_days double",
    )
    risk = {r["customer_unique_id"]: r["risk"] for r in churn.with_risk(features).collect()}
    assert risk["no review"] == pytest.approx(0.15 + 0.15 + 0.2 * 1.25)
    assert risk["extreme"] == pytest.approx(0.3 + 0.2 + 0.2)


def test_class_weights(spark):
    labels = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    assert {r["label"]: r["weight"] for r in churn.class_weights(labels).collect()} == {0.0: 4 / 6, 1.0: 2.0}
    one_class = churn.class_weights(labels.filter("label = 0")).collect()
    assert {r["label"]: r["weight"] for r in one_class} == {0.0: 0.5, 1.0: 1.0}


def test_display_names(spark):
    from souk.functions.categories import with_display_name

    df = spark.createDataFrame([("toys",), ("new_thing_2",), (None,)], "c string")
    found = {r["c"]: r["display_name"] for r in with_display_name(df, "c").collect()}
    assert found == {"toys": "Đồ chơi", "new_thing_2": "New Thing 2", None: "Khong xac dinh"}
    english = {r["c"]: r["display_name"] for r in with_display_name(df, "c", language="en").collect()}
    assert english == {"toys": "Toys", "new_thing_2": "New Thing 2", None: "Unknown"}


def test_latest_order(orders):
    found = by_id(dashboard.latest_order_per_customer(orders), "customer_unique_id")
    assert found["uc1"]["order_id"] == "on_time"
    assert found["uc2"]["item_count"] == 0


def test_shares_and_counts_agree(shop):
    total = shop.orders.count()
    for report in (reports.orders_by_status, reports.orders_by_state, reports.payment_methods):
        found = report(shop.orders).agg(F.sum("order_count"), F.sum("percentage")).first()
        assert found[0] == total
        assert found[1] == pytest.approx(100, abs=0.5)


def test_reviewed_only_leaves_out_orders_without_review(orders):
    every = by_id(rfm.rfm_customers(orders), "customer_unique_id")["uc1"]["avg_review_score"]
    reviewed = by_id(rfm.rfm_customers(orders, reviewed_only=True), "customer_unique_id")["uc1"]["avg_review_score"]
    assert reviewed == 4.0
    assert every < reviewed


def test_lookup_of_many_keys(spark):
    from souk.operators.rows import lookup_many

    df, keys = spark.range(10), spark.createDataFrame([(3,), (3,), (99,)], "id long")
    assert [r["id"] for r in lookup_many(df, keys, "id").collect()] == [3]
