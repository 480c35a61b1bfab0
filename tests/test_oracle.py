"""Every registered query against its SQL in an independent engine, on the smallest data set."""

import pytest
from compare import connect, differences
from conftest import SF

from souk import catalog, oracle

SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    assert differences(catalog.run(name, spark, SF), duck, SQL[name]) == []


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(catalog.QUERIES)


def test_queries_without_sql_are_models_or_sketches():
    assert set(catalog.QUERIES) - set(SQL) == {
        "order_percentiles_approx",
        "kmeans_segments",
        "kmeans_quality",
        "churn_scored",
        "model_or_formula_scores",
        "churn_scored_v2",
        "churn_metrics",
        "confusion_matrix",
        "feature_importance",
        "churn_rf",
        "churn_lr",
        "review_rf",
        "review_lr",
        "best_model",
        "model_metrics_json",
        "model_table",
    }


def test_entry_runs(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.columns[0] == "purchase_year_month"
    assert result.count() > 12
