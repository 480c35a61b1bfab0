"""Queries that use several customer, model or summary tables join and aggregate the raw tables once."""

import pytest
from conftest import SF

from souk import catalog
from souk.models import churn, reviews
from souk.operators.staging import scope, stage


@pytest.fixture
def from_items(monkeypatch):
    """The tables that are written straight from the raw items."""
    found = []

    def noted(df):
        if any("lineitem" in file for file in df.inputFiles()):
            found.append(df.columns)
        return stage(df)

    monkeypatch.setattr(catalog, "stage", noted)
    return found


def rows_of(df):
    return sorted(df.collect(), key=str)


def test_models_share_one_written_table_of_orders(spark, from_items):
    with scope(spark):
        s = catalog.Shop(spark, SF)
        legacy, rows, _ = s.legacy, s.review_rows, s.labelled
        assert len(from_items) == 1
        assert rows_of(legacy) == rows_of(churn.legacy_features(s.orders_scored))
        assert rows_of(rows) == rows_of(reviews.review_rows(s.orders))


def test_customers_alone_do_not_write_the_models_columns(spark, from_items):
    with scope(spark):
        catalog.Shop(spark, SF).features.count()
        assert len(from_items) == 1 and reviews.CATEGORY not in from_items[0]


def test_summaries_and_customers_share_one_written_table_of_orders(spark, from_items):
    with scope(spark):
        s = catalog.Shop(spark, SF)
        catalog.aggregation_documents(s).count()
        assert len(from_items) == 1
        direct = catalog.Shop(spark, SF)
        assert rows_of(s.features) == rows_of(direct.features)
