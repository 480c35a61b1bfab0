"""Model results as JSON records, and the flat table a model page shows."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCORES = ("accuracy", "precision", "recall", "f1_score", "auc_roc", "rmse", "r2", "mae")
METRICS_SCHEMA = (
    f"best_model string, models map<string, struct<{', '.join(f'{s}: double' for s in SCORES)}>>, "
    "confusion_matrix struct<true_positive: bigint, true_negative: bigint, false_positive: bigint, "
    "false_negative: bigint>, feature_importance map<string, double>"
)


def result(
    name: str,
    scores: Mapping[str, Mapping[str, float]],
    best: str = "N/A",
    confusion: DataFrame | None = None,
    importance: DataFrame | None = None,
) -> dict[str, Any]:
    """One model family's results. The confusion and importance tables have a handful of rows."""
    found: dict[str, Any] = {"model_name": name, "best_model": best, "models": {k: dict(v) for k, v in scores.items()}}
    if confusion is not None:
        cells = {(r["label"], r["prediction"]): r["row_count"] for r in confusion.collect()}
        found["confusion_matrix"] = {
            "true_positive": cells.get((1.0, 1.0), 0),
            "true_negative": cells.get((0.0, 0.0), 0),
            "false_positive": cells.get((0.0, 1.0), 0),
            "false_negative": cells.get((1.0, 0.0), 0),
        }
    if importance is not None:
        found["feature_importance"] = {r["feature"]: r["importance"] for r in importance.collect()}
    return found


def records(spark: SparkSession, results: list[Mapping[str, Any]]) -> DataFrame:
    """One row per model family with its metrics encoded as JSON."""
    nested = spark.createDataFrame([dict(r) for r in results], f"model_name string, {METRICS_SCHEMA}")
    body = F.to_json(F.struct("best_model", "models", "confusion_matrix", "feature_importance"))
    tag = F.lit("model_performance").alias("agg_type")
    return nested.select("model_name", "best_model", body.alias("metrics_json"), tag)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records that were written as JSON documents."""
    schema = "model_name string, best_model string, metrics_json string, agg_type string"
    return spark.read.schema(schema).json(path)


def model_table(performance: DataFrame) -> DataFrame:
    """One row per model: scores, [[tn, fp], [fn, tp]] and importances in falling order. Best model marked ``*``."""
    metrics = performance.select(F.from_json("metrics_json", METRICS_SCHEMA).alias("m")).select("m.*")
    one = metrics.select("*", F.explode("models").alias("name", "scores"))
    cells = F.col("confusion_matrix")
    matrix = F.array(
        F.array(cells.getField("true_negative"), cells.getField("false_positive")),
        F.array(cells.getField("false_negative"), cells.getField("true_positive")),
    )
    by_importance = F.transform(
        F.array_sort(F.map_entries("feature_importance"), lambda a, b: F.signum(b["value"] - a["value"]).cast("int")),
        lambda e: F.struct(e["key"].alias("feature"), e["value"].alias("importance")),
    )
    score = F.col("scores").getField
    return one.select(
        F.concat("name", F.when(F.col("name") == F.col("best_model"), " *").otherwise("")).alias("name"),
        (score("rmse").isNotNull() & score("auc_roc").isNull()).alias("is_regression"),
        F.coalesce(score("accuracy"), score("r2"), F.lit(0.0)).alias("accuracy"),
        score("precision").alias("precision"),
        score("recall").alias("recall"),
        score("f1_score").alias("f1"),
        score("auc_roc").alias("auc"),
        score("rmse").alias("rmse"),
        score("r2").alias("r2"),
        score("mae").alias("mae"),
        F.when(cells.isNotNull(), matrix).alias("confusion_matrix"),
        by_importance.alias("feature_importance"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
