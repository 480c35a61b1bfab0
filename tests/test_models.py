"""Models: ranges, repeatability and agreement between their own outputs."""

import pytest
from pyspark.sql import functions as F

from souk.models import churn, evaluation, results, reviews, segments


def test_segments_are_named_by_spend(shop):
    found = shop.segmentation.segments(shop.segment_rows)
    means = found.groupBy("segment_name").agg(F.avg("monetary").alias("m"))
    spend = {r["segment_name"]: r["m"] for r in means.collect()}
    assert spend["Champions"] == max(spend.values())
    assert spend["Lost"] == min(spend.values())
    assert found.count() == shop.segment_rows.count()


def test_segmentation_repeats(shop):
    again = segments.fit(shop.segment_rows)
    assert -1 <= again.silhouette(shop.segment_rows) <= 1
    assert again.silhouette(shop.segment_rows) == pytest.approx(shop.segmentation.silhouette(shop.segment_rows))


def test_boosting_scores_every_customer(shop):
    scored = shop.boosted.scored(shop.labelled)
    assert scored.count() == shop.features.count()
    low, high = scored.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= low <= high <= 1
    assert {r[0] for r in scored.select("split").distinct().collect()} == {"train", "test"}


def test_metrics_agree_with_the_confusion_matrix(shop):
    cells = {(r["label"], r["prediction"]): r["row_count"] for r in shop.boosted.confusion(shop.labelled).collect()}
    right = sum(n for (label, guess), n in cells.items() if label == guess)
    scores = shop.boosted.scores(shop.labelled)
    assert scores["accuracy"] == pytest.approx(right / sum(cells.values()), abs=1e-4)
    assert scores["recall"] == scores["accuracy"]
    assert 0.5 <= scores["auc_roc"] <= 1


def test_weighted_scores_equal_spark(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(0.0, 0.0)] * 7 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(1.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    cells = {(r["label"], r["prediction"]): r["row_count"] for r in evaluation.confusion_matrix(df).collect()}
    ours = evaluation.weighted_scores(cells)
    for name, metric in (("accuracy", "accuracy"), ("f1_score", "f1"), ("precision", "weightedPrecision")):
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df))


def test_importances_sum_to_one_and_fall(shop):
    found = [r["importance"] for r in shop.boosted.importance(shop.labelled).collect()]
    assert sum(found) == pytest.approx(1, abs=1e-3)
    assert found == sorted(found, reverse=True)


def test_second_boosted_model_learns_the_min_max_label(shop):
    from souk.plans.churn import minmax_risk

    rows = shop.stratified.select("customer_unique_id", "label", "risk")
    wanted = minmax_risk(shop.customers).selectExpr("customer_unique_id", "cast(label as double) label", "risk")
    assert rows.exceptAll(wanted).count() == 0 and rows.count() == wanted.count()
    assert set(churn.FEATURES) <= set(shop.stratified.columns)


def test_training_is_spread_over_the_cores(spark, shop):
    width = spark.sparkContext.defaultParallelism
    assert churn.spread(churn.training_rows(shop.labelled), "customer_unique_id").rdd.getNumPartitions() >= width


def test_legacy_models(shop):
    assert set(churn.LEGACY_FEATURES) < set(shop.legacy.columns)
    for model in (shop.forest, shop.logistic):
        assert set(model.scores(shop.legacy)) == {"auc_roc", "accuracy", "f1_score", "precision", "recall"}


def test_review_models(shop):
    for model in (shop.review_forest, shop.review_line):
        scores = model.scores(shop.review_rows)
        assert 0 < scores["mae"] <= scores["rmse"] < 5
    assert len(reviews.FEATURES) == 7


def test_model_table(spark, shop):
    found = results.model_table(shop.model_records).collect()
    table = {r["name"].rstrip(" *"): r for r in found if not r["is_regression"]}
    assert set(table) == {"GradientBoosting", "RandomForest", "LogisticRegression"}
    row = table["GradientBoosting"]
    cells = {(r["label"], r["prediction"]): r["row_count"] for r in shop.boosted.confusion(shop.labelled).collect()}
    assert row["confusion_matrix"][1][1] == cells.get((1.0, 1.0), 0)
    assert row["confusion_matrix"][0][1] == cells.get((0.0, 1.0), 0)
    values = [e["importance"] for e in row["feature_importance"]]
    assert values == sorted(values, reverse=True)


def test_best_model(spark):
    metrics = evaluation.metrics_table(spark, {"a": {"auc_roc": 0.7, "rmse": 2.0}, "b": {"auc_roc": 0.9, "rmse": 3.0}})
    assert evaluation.best_model(metrics, "auc_roc").first()["best_model"] == "b"
    assert evaluation.best_model(metrics, "rmse", smallest=True).first()["best_model"] == "a"


def test_saved_model_predicts_the_same(spark, shop, tmp_path):
    path = str(tmp_path / "model")
    results.save_model(shop.boosted.model, path)
    again = churn.Churn(results.load_model(path), shop.boosted.features)
    wrong = again.scored(shop.labelled).exceptAll(shop.boosted.scored(shop.labelled))
    assert wrong.count() == 0


def test_serving_with_and_without_a_model(shop):
    customers = shop.customers
    from_model, from_formula = churn.served(customers, shop.boosted), churn.served(customers)
    assert from_model.columns == from_formula.columns
    for scored in (from_model, from_formula):
        assert scored.count() == customers.count()
        assert scored.filter(~F.col("probability").between(0, 1)).count() == 0
        assert scored.filter(F.col("at_risk") != F.col("risk_level").isin("high", "very high")).count() == 0


def test_segment_checks(shop):
    found = segments.checks(shop.segmentation, shop.segment_rows).first()
    assert found["customers"] == shop.segment_rows.count()
    assert found["nearest"] and found["centred"] and found["silhouette_agrees"]


def test_segment_checks_notice_other_rows_and_wrong_centres(shop, monkeypatch):
    moved = shop.segment_rows.withColumn("monetary", F.col("monetary") * 3 + 1000)
    assert not segments.checks(shop.segmentation, moved).first()["centred"]

    def shifted(self, inputs):
        return self.model.transform(inputs).withColumn("cluster", (F.col("cluster") + 1) % segments.CLUSTERS)

    monkeypatch.setattr(segments.Segmentation, "assign", shifted)
    found = segments.checks(shop.segmentation, shop.segment_rows).first()
    assert not found["nearest"] and not found["centred"]


def test_segment_checks_of_no_rows(shop):
    found = segments.checks(shop.segmentation, shop.segment_rows.limit(0)).first()
    assert tuple(found) == (0, True, True, True)


def test_boosting_trains_in_few_tasks_and_large_tables_in_more(shop, monkeypatch):
    rows = shop.labelled.limit(40)
    n = rows.count()
    assert churn.gathered(rows, "customer_unique_id").rdd.getNumPartitions() == 1
    monkeypatch.setattr(churn, "ROWS_PER_TASK", 1)
    assert churn.gathered(rows, "customer_unique_id").rdd.getNumPartitions() == n


def test_forest_scores_in_a_session_with_job_tags(spark):
    """A session with tags cannot be serialized, so the fitted forest must not carry it to the tasks."""
    rows = [(i, float(i % 7), float(i % 7 > 3), "train" if i % 5 else "test") for i in range(60)]
    labelled = spark.createDataFrame(rows, "customer_unique_id long, x double, label double, split string")
    spark.addTag("tagged")
    try:
        scores = churn.random_forest(labelled, ["x"]).scores(labelled)
    finally:
        spark.removeTag("tagged")
    assert scores["accuracy"] == 1.0
