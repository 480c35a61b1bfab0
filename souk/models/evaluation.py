"""Metrics as tables. What leaves the cluster per model is a confusion table of a few rows and one number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.functions.measures import rows, rows_where
from souk.operators.ordering import asc
from souk.operators.ranking import PART_SHIFT, ROW_ID, range_sorted

METRIC_SCHEMA = "model string, metric string, value double"


def positive_probability(probability: str = "probability") -> Column:
    return F.round(F.get(vector_to_array(F.col(probability)), F.lit(1)), 4)


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Counts per (label, prediction), from one pass."""
    return predictions.groupBy("label", "prediction").agg(rows().alias("row_count")).orderBy("label", "prediction")


def _ratio(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def weighted_scores(cells: Mapping[tuple[float, float], int]) -> dict[str, float]:
    """Accuracy and class-weighted precision, recall and F1 of a confusion matrix."""
    total = sum(cells.values())
    scores = dict.fromkeys(("accuracy", "f1_score", "precision", "recall"), 0.0)
    for c in {label for label, _ in cells}:
        hit = cells.get((c, c), 0)
        actual = sum(n for (label, _), n in cells.items() if label == c)
        predicted = sum(n for (_, guess), n in cells.items() if guess == c)
        precision, recall = _ratio(hit, predicted), _ratio(hit, actual)
        share = _ratio(actual, total)
        scores["accuracy"] += _ratio(hit, total)
        scores["precision"] += share * precision
        scores["recall"] += share * recall
        scores["f1_score"] += share * _ratio(2 * precision * recall, precision + recall)
    return scores


def classification_scores(predictions: DataFrame) -> dict[str, float]:
    cells = {(r["label"], r["prediction"]): r["row_count"] for r in confusion_matrix(predictions).collect()}
    # numBins=0 keeps every distinct score on the curve, however many there are.
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0)
    area = area.evaluate(predictions)
    return {name: round(value, 4) for name, value in ({"auc_roc": area} | weighted_scores(cells)).items()}


def rank_area(predictions: DataFrame, score: str = "rawPrediction") -> DataFrame:
    """(rows_scored, positives, auc): the area under the ROC curve as a rank sum, ties counting half.

    Equal scores are merged, the others sorted over all partitions; each partition counts the negatives below its
    rows itself and gets those of the partitions before it from one row per partition. Sums are exact. NULL if a class
    is empty.
    """
    one = F.col("label") == 1
    counted = predictions.groupBy(score).agg(rows_where(one).alias("ones"), rows_where(~one).alias("zeros"))
    ordered = range_sorted(counted, [asc(score)]).withColumn("part", F.shiftright(ROW_ID, PART_SHIFT))
    totals = ordered.groupBy("part").agg(F.sum("zeros").alias("zeros")).orderBy("part").collect()
    starts, below = [], 0
    for row in totals:
        starts.append((row["part"], below))
        below += row["zeros"]
    offsets = F.broadcast(predictions.sparkSession.createDataFrame(starts, "part long, offset long"))
    before = Window.partitionBy("part").orderBy(ROW_ID).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ordered.withColumn("inside", F.coalesce(F.sum("zeros").over(before), F.lit(0))).join(offsets, "part")
    twice = 2 * (F.col("offset") + F.col("inside")) + F.col("zeros")
    sums = ranked.agg(
        F.coalesce(F.sum(F.col("ones") + F.col("zeros")), F.lit(0)).cast("long").alias("rows_scored"),
        F.coalesce(F.sum("ones"), F.lit(0)).cast("long").alias("positives"),
        F.sum(F.col("ones").cast("decimal(19,0)") * twice.cast("decimal(19,0)")).alias("won"),
    )
    pairs = F.col("positives").cast("double") * (F.col("rows_scored") - F.col("positives"))
    return sums.select("rows_scored", "positives", F.try_divide(F.col("won").cast("double"), 2 * pairs).alias("auc"))


def regression_scores(predictions: DataFrame, label: str) -> dict[str, float]:
    evaluator = RegressionEvaluator(labelCol=label)
    return {
        name: round(evaluator.evaluate(predictions, {evaluator.metricName: name}), 4) for name in ("rmse", "r2", "mae")
    }


def metrics_table(spark: SparkSession, scores: Mapping[str, Mapping[str, float]]) -> DataFrame:
    long = [(model, metric, float(value)) for model, m in scores.items() for metric, value in m.items()]
    return spark.createDataFrame(long, METRIC_SCHEMA)


def best_model(metrics: DataFrame, metric: str, smallest: bool = False) -> DataFrame:
    pick = F.min_by if smallest else F.max_by
    end = F.min if smallest else F.max
    return metrics.filter(F.col("metric") == metric).agg(
        pick("model", "value").alias("best_model"), end("value").alias("value")
    )


def importance_table(spark: SparkSession, features: Sequence[str], importances: Vector) -> DataFrame:
    ranked = sorted(zip(features, importances.toArray().tolist(), strict=True), key=lambda pair: -pair[1])
    return spark.createDataFrame([(f, round(v, 4)) for f, v in ranked], "feature string, importance double")
