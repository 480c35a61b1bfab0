"""Review score of an order, predicted from its price, freight, delivery and category."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.models import evaluation
from souk.models.churn import spread, test_rows, training_rows
from souk.operators.rows import with_split
from souk.plans.reports import reviewed

LABEL, CATEGORY = "review_score", "main_category_english"
NUMBERS = (
    "total_price",
    "total_freight_value",
    "delivery_days",
    "total_payment_value",
    "total_items",
    "freight_ratio",
)
FEATURES = (*NUMBERS, "category_index")
#: The order columns that ``review_rows`` reads.
COLUMNS = ("order_id", CATEGORY, LABEL, *NUMBERS)

# Model parameters.
FOREST = {"numTrees": 50, "maxDepth": 8, "seed": 42}
LEAST_BINS = 80


@dataclass(frozen=True)
class ReviewModel:
    model: PipelineModel

    def predictions(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows).select("order_id", LABEL, "prediction", "split")

    def scores(self, rows: DataFrame) -> dict[str, float]:
        return evaluation.regression_scores(self.predictions(test_rows(rows)), LABEL)


def review_rows(orders: DataFrame) -> DataFrame:
    numbers = [F.col(c).cast("double").alias(c) for c in NUMBERS]
    rows = reviewed(orders).select("order_id", CATEGORY, *numbers, F.col(LABEL).cast("double").alias(LABEL))
    return with_split(rows, "order_id")


def _fit(rows: DataFrame, regressor) -> ReviewModel:
    training = spread(training_rows(rows), "order_id").persist()
    try:
        stages = [
            StringIndexer(inputCol=CATEGORY, outputCol="category_index", handleInvalid="keep"),
            VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="skip"),
            regressor,
        ]
        return ReviewModel(Pipeline(stages=stages).fit(training))
    finally:
        training.unpersist()


def random_forest(rows: DataFrame) -> ReviewModel:
    """Every category needs a bin of its own, and unseen ones share one more."""
    categories = rows.agg(F.count_distinct(CATEGORY)).first()[0]
    return _fit(rows, RandomForestRegressor(labelCol=LABEL, maxBins=max(LEAST_BINS, categories + 2), **FOREST))


def linear_regression(rows: DataFrame) -> ReviewModel:
    return _fit(rows, LinearRegression(labelCol=LABEL))
