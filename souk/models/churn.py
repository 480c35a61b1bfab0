"""Churn classifiers on the five risk factors and on the nine-column legacy feature set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.measures import mean, mean_of_ratios
from souk.models import evaluation
from souk.operators.rows import with_split, with_stratified_split
from souk.plans.churn import (
    FEATURES,
    TRAINING_DEFAULTS,
    minmax_risk,
    serving_scores,
    with_class_weight,
    with_levels,
    with_risk,
)
from souk.plans.rfm import CUSTOMER
from souk.plans.silver import with_defaults

SEED = 42

# Model parameters.
GBT = {"maxIter": 50, "maxDepth": 5, "seed": SEED}
GBT_SLOW = {"maxIter": 150, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": SEED}
FOREST = {"numTrees": 50, "maxDepth": 8, "seed": SEED}

LEGACY_FEATURES = (
    "frequency",
    "monetary",
    "f_score",
    "m_score",
    "avg_review",
    "avg_delivery_days",
    "total_items_bought",
    "avg_payment",
    "category_diversity",
)


@dataclass(frozen=True)
class Churn:
    """A fitted classifier with the features it reads, in order."""

    model: PipelineModel
    features: tuple[str, ...]

    def predictions(self, labelled: DataFrame) -> DataFrame:
        return self.model.transform(labelled)

    def scored(self, labelled: DataFrame) -> DataFrame:
        """Every customer with label, prediction and probability; ``split`` tells which rows trained the model."""
        return self.predictions(labelled).select(
            CUSTOMER, "label", "prediction", evaluation.positive_probability().alias("churn_probability"), "split"
        )

    def scores(self, labelled: DataFrame) -> dict[str, float]:
        return evaluation.classification_scores(self.predictions(test_rows(labelled)))

    def confusion(self, labelled: DataFrame) -> DataFrame:
        return evaluation.confusion_matrix(self.predictions(test_rows(labelled)))

    def importance(self, labelled: DataFrame) -> DataFrame:
        found = self.model.stages[-1].featureImportances
        return evaluation.importance_table(labelled.sparkSession, self.features, found)


def served(customers: DataFrame, model: Churn | None = None) -> DataFrame:
    """Probability, label and level of every customer: from the model, or from the risk formula if there is none."""
    if model is None:
        return serving_scores(customers)
    inputs = with_defaults(
        customers.select(
            CUSTOMER,
            "recency",
            "frequency",
            F.col("monetary").cast("double").alias("monetary"),
            F.col("avg_review_score").alias("avg_review"),
            "avg_delivery_days",
        ),
        TRAINING_DEFAULTS,
    )
    probability = F.round(evaluation.positive_probability(), 3).alias("probability")
    return with_levels(model.predictions(inputs).select(CUSTOMER, probability))


def training_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("split") == "train")


def test_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("split") == "test")


test_rows.__test__ = False


def spread(rows: DataFrame, key: str) -> DataFrame:
    """At least one partition per core: a small written table is read in one, and would be trained on in one task."""
    spark = rows.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(width, key)


#: Training rows of one task of a boosted model.
ROWS_PER_TASK = 50_000


def gathered(rows: DataFrame, key: str) -> DataFrame:
    """Partitions of about ``ROWS_PER_TASK`` rows, for boosting: its six jobs a tree run one after another, hundreds of
    them, and on a small table a task costs more to start and to report than to run."""
    return rows.repartition(max(1, -(-rows.count() // ROWS_PER_TASK)), key)


def labelled_customers(features: DataFrame) -> DataFrame:
    """Features with risk, label, class weight and an 80/20 split that depends on the customer id alone."""
    return with_split(with_class_weight(with_risk(features)), CUSTOMER)


def stratified_customers(customers: DataFrame) -> DataFrame:
    """Customer documents with the risk scaled to the range of each factor, the label above one half, and a split
    stratified by that label. Missing inputs count as 0, as in the label."""
    labelled = minmax_risk(customers).select(
        CUSTOMER,
        "recency",
        "frequency",
        F.col("monetary").cast("double").alias("monetary"),
        F.col("avg_review_score").alias("avg_review"),
        "avg_delivery_days",
        "risk",
        F.col("label").cast("double").alias("label"),
    )
    return with_stratified_split(labelled, CUSTOMER, "label")


def _fit(
    labelled: DataFrame, features: Sequence[str], *tail: Estimator, vector: str = "features", deal=spread
) -> Churn:
    """Fit on the training rows, which stay persisted while the estimator passes over them repeatedly.

    The model is a copy: Spark sends a random forest to the tasks with its training summary, which holds the session, and
    a session with job tags cannot be serialized. A forest's copy has no summary.
    """
    training = deal(training_rows(labelled), CUSTOMER).persist()
    try:
        assembler = VectorAssembler(inputCols=list(features), outputCol=vector, handleInvalid="skip")
        return Churn(Pipeline(stages=[assembler, *tail]).fit(training).copy(), tuple(features))
    finally:
        training.unpersist()


def gradient_boosting(labelled: DataFrame) -> Churn:
    return _fit(labelled, FEATURES, GBTClassifier(weightCol="weight", **GBT), deal=gathered)


def slow_gradient_boosting(labelled: DataFrame) -> Churn:
    """150 small steps on standardised inputs with 80 % row sampling, for a stratified split."""
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return _fit(labelled, FEATURES, scaler, GBTClassifier(**GBT_SLOW), vector="raw_features", deal=gathered)


def random_forest(labelled: DataFrame, features: Sequence[str] = LEGACY_FEATURES) -> Churn:
    return _fit(labelled, features, RandomForestClassifier(**FOREST))


def logistic_regression(labelled: DataFrame, features: Sequence[str] = LEGACY_FEATURES) -> Churn:
    return _fit(labelled, features, LogisticRegression())


def legacy_features(orders: DataFrame) -> DataFrame:
    """Per customer, the older feature set with ``churn`` (no purchase for 90 days) as label.

    ``orders`` carries the customer scores. Items bought is the sum of items, payment the mean order payment and
    category diversity the number of distinct main categories.
    """
    of_customer = [F.max(c).cast("double").alias(c) for c in ("frequency", "monetary", "f_score", "m_score")]
    per_customer = orders.groupBy(CUSTOMER).agg(
        *of_customer,
        mean_of_ratios("review_score").alias("avg_review"),
        mean("delivery_days").alias("avg_delivery_days"),
        F.sum("total_items").cast("double").alias("total_items_bought"),
        mean("total_payment_value").alias("avg_payment"),
        F.count_distinct("main_category_english").cast("double").alias("category_diversity"),
        F.max("churn").cast("double").alias("label"),
    )
    return with_split(per_customer, CUSTOMER)
