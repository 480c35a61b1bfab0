"""Customer scores from folded batches against those computed from all orders."""

import pytest
from pyspark.sql import functions as F
from test_plans import plan
from test_upkeep import rows_of

from souk.operators.ordering import after
from souk.operators.staging import stage
from souk.plans import rfm, rfm_upkeep
from souk.plans.rfm import CUSTOMER


@pytest.fixture(scope="module")
def orders(shop):
    return stage(shop.orders.select(*rfm_upkeep.ORDER_COLUMNS))


def same(spark, root, orders):
    return rows_of(rfm_upkeep.scored(spark, root)) == rows_of(rfm.rfm_scores(orders))


def test_three_batches_with_late_orders_equal_the_full_build(spark, orders, tmp_path):
    root, so_far = str(tmp_path / "state"), None
    year = F.year("order_purchase_timestamp")
    middle = orders.agg(F.floor(F.avg(year))).first()[0]
    parts = [year > middle, (year <= middle) & (F.col("order_id") % 2 == 0), (year <= middle) & (F.col("order_id") % 2 == 1)]
    for batch, condition in enumerate(parts):
        part = orders.filter(condition)
        assert part.filter("order_status = 'delivered'").count() > 0
        rfm_upkeep.fold(spark, root, part, batch)
        so_far = part if so_far is None else so_far.unionByName(part)
        assert same(spark, root, so_far)
    assert rfm_upkeep.versions(spark, root) == [1, 2]


def test_ranges_hold_the_counts_of_the_state(spark, orders, tmp_path):
    root = str(tmp_path / "state")
    for batch in range(3):
        rfm_upkeep.fold(spark, root, orders.filter(F.col("order_id") % 3 == batch), batch)
    _, ranges = rfm_upkeep._read_counts(spark, root, 2)
    state = rfm_upkeep._with_last_day(spark.read.parquet(rfm_upkeep._version(root, 2, "customers")))
    for score in rfm_upkeep.STATE_KEYS:
        own = [r for r in ranges if r.score == score]
        found = {r[0]: r[1] for r in state.groupBy(rfm_upkeep._place(score, own, state)).count().collect()}
        assert {i: r.rows for i, r in enumerate(own) if r.rows} == found and 1 < len(own) <= rfm_upkeep.RANGES


def test_a_batch_given_again_changes_nothing_and_an_old_one_is_refused(spark, orders, tmp_path):
    root = str(tmp_path / "state")
    rfm_upkeep.fold(spark, root, orders.filter("order_id % 2 = 0"), 1)
    rfm_upkeep.fold(spark, root, orders.filter("order_id % 2 = 1"), 4)
    rfm_upkeep.fold(spark, root, orders, 4)
    assert same(spark, root, orders)
    with pytest.raises(ValueError, match="batch 1"):
        rfm_upkeep.fold(spark, root, orders, 1)


def test_a_failed_batch_is_repeated(spark, orders, tmp_path, monkeypatch):
    root = str(tmp_path / "state")
    rfm_upkeep.fold(spark, root, orders.filter("order_id % 2 = 0"), 0)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(rfm_upkeep, "_write_counts", fails)
        with pytest.raises(OSError, match="lost"):
            rfm_upkeep.fold(spark, root, orders.filter("order_id % 2 = 1"), 1)
    assert rfm_upkeep.versions(spark, root) == [0] and same(spark, root, orders.filter("order_id % 2 = 0"))
    rfm_upkeep.fold(spark, root, orders.filter("order_id % 2 = 1"), 1)
    assert same(spark, root, orders)


def test_changed_and_withdrawn_orders(spark, orders, tmp_path):
    """The last purchase and every second order go; their customers are built anew from what is left."""
    root = str(tmp_path / "state")
    rfm_upkeep.fold(spark, root, orders, 0)
    last = orders.agg(F.max("order_purchase_timestamp")).first()[0]
    gone = (F.col("order_purchase_timestamp") == F.lit(last)) | (F.col("order_id") % 2 == 0)
    left = orders.filter(~gone)
    rfm_upkeep.rebuild(spark, root, left, orders.filter(gone), 1)
    assert same(spark, root, left)


def test_empty_and_odd_batches(spark, orders, tmp_path):
    root, none = str(tmp_path / "state"), orders.limit(0)
    rfm_upkeep.fold(spark, root, none, 0)
    assert rfm_upkeep.scored(spark, root).count() == 0
    nobody = orders.limit(5).withColumn(CUSTOMER, F.lit(None).cast(dict(orders.dtypes)[CUSTOMER]))
    nobody = nobody.withColumns(
        {"order_status": F.lit("delivered"), "order_purchase_timestamp": F.expr("timestamp_ntz'2030-01-05 00:00:00'")}
    )
    rfm_upkeep.fold(spark, root, nobody, 1)  # moves the day from which recency is counted, and no customer
    few = orders.filter("order_status = 'delivered'").orderBy("order_id").limit(3)
    bare = few.withColumns({"review_score": F.lit(None).cast(dict(orders.dtypes)["review_score"])})
    rfm_upkeep.fold(spark, root, bare, 2)
    rfm_upkeep.fold(spark, root, none, 3)
    assert same(spark, root, nobody.unionByName(bare))


def test_earlier_orders_are_not_read(spark, orders, tmp_path):
    root = str(tmp_path / "state")
    rfm_upkeep.fold(spark, root, orders, 0)
    read = set(rfm_upkeep.scored(spark, root).inputFiles())
    assert read and all("/v0/customers/" in f for f in read)


def test_rows_are_placed_by_halving(spark):
    """Rows before, on, between and behind the limits, NULLs and any number of ranges; few comparisons a row."""
    values = [None, *range(-2, 30)]
    rows = spark.createDataFrame([(v, c) for v in values for c in (0, 1)], f"frequency long, {CUSTOMER} long")
    for n in (1, 2, 3, 8, 9):
        firsts = [{"frequency": v, CUSTOMER: 1} for v in range(3 * n, 0, -3)]
        firsts[-1] = {"frequency": None, CUSTOMER: 1} if n > 2 else firsts[-1]
        ranges = [rfm_upkeep.Range("f_score", first, 1) for first in firsts]
        place = rfm_upkeep._place("f_score", ranges, rows)
        wanted = sum(
            (after(rfm_upkeep.STATE_KEYS["f_score"], first, inclusive=True).cast("int") for first in firsts[1:]), F.lit(0)
        )
        assert rows.filter(place != wanted).count() == 0
    assert "filter(" not in plan(rows.select(place))
