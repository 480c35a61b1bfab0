"""The whole batch: raw files to bronze, bronze to silver, silver to gold, gold to documents and reports.

Each layer is written before the next one reads it, so no later stage recomputes an earlier one, and a lost executor
costs at most the stage it was working on.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.models import churn as churn_models
from souk.models import evaluation, results, segments
from souk.operators import quality
from souk.operators.staging import scope, stage
from souk.plans import churn, collection, documents, reports, rfm, silver, upkeep
from souk.sources import lake, ledger, raw_csv
from souk.sources.contracts import CONTRACTS
from souk.sources.tables import from_bronze


@dataclass(frozen=True)
class Layout:
    """Folders of the layers below one root."""

    root: str

    def at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def bronze(self) -> str:
        return self.at("bronze")

    @property
    def silver_orders(self) -> str:
        return self.at("silver", "merged_orders")

    @property
    def orders_base(self) -> str:
        return self.at("silver", "orders_base")

    def gold(self, name: str) -> str:
        return self.at("gold", name)

    def documents(self, name: str) -> str:
        return self.at("documents", name)


def ingest(spark: SparkSession, raw: Mapping[str, str], layout: Layout) -> DataFrame:
    """Land what is new or changed of every raw table that exists, and write the manifest. A table that breaks its
    contract still lands.

    Checks read the landed Parquet, so the one-task-per-file CSV parse happens once for each state of a file.
    """
    rows = []
    for name, path in raw.items():
        if raw_csv.exists(spark, path):
            ledger.land_changed(spark, name, path, layout.bronze)
            landed = raw_csv.landed(spark, name, layout.bronze)
            checked = landed.drop(raw_csv.SOURCE_FILE, raw_csv.INGESTED_AT, raw_csv.FILE_KEY)
            rejected = raw_csv.landed(spark, name, layout.bronze, rejects=True)
            rows.append(quality.table_report(name, checked, CONTRACTS[name], rejected))
        else:
            rows.append(quality.absent_report(spark, name))
    manifest = rows[0]
    for row in rows[1:]:
        manifest = manifest.unionByName(row)
    manifest.write.mode("overwrite").json(layout.at("manifest"))
    return spark.read.schema(manifest.schema).json(layout.at("manifest"))


def build_silver(spark: SparkSession, layout: Layout) -> int:
    """Customer scores first, then the order table that carries them."""
    upkeep.write_by_month(silver.silver_orders(from_bronze(spark, layout.bronze)), layout.orders_base)
    return score_silver(spark, layout)


def score_silver(spark: SparkSession, layout: Layout) -> int:
    """Scores of all customers, which move with the last purchase date, and the order table with them."""
    written = upkeep.read_by_month(spark, layout.orders_base)
    lake.write(rfm.rfm_scores(written), layout.gold("rfm_customers"))
    scored = lake.read(spark, layout.gold("rfm_customers"))
    return lake.write(rfm.orders_with_rfm(written, scored), layout.silver_orders)


def update(spark: SparkSession, raw: Mapping[str, str], layout: Layout) -> list[str] | None:
    """Land changed files and rebuild only the months of the orders in them; returns these months.

    A change in customers, products, sellers or translations may concern any order, so then, and where there is no silver
    table yet, everything is built and None returned.
    """
    there = {name: path for name, path in raw.items() if raw_csv.exists(spark, path)}
    changed = {name: ledger.changed_keys(spark, name, path, layout.bronze) for name, path in there.items()}
    lookups = set(CONTRACTS) - set(upkeep.BY_ORDER) - {"geolocation"}
    fresh = not raw_csv.exists(spark, layout.orders_base, "parquet")
    if fresh or any(changed.get(name) for name in lookups):
        ingest(spark, raw, layout)
        build_silver(spark, layout)
        return None

    def ids() -> DataFrame | None:
        parts = [
            raw_csv.landed(spark, name, layout.bronze).filter(F.col(raw_csv.FILE_KEY).isin(changed[name])).select("order_id")
            for name in upkeep.BY_ORDER
            if changed.get(name)
        ]
        return reduce(DataFrame.unionByName, parts) if parts else None

    with scope(spark):
        before = ids()
        if before is None:
            ingest(spark, raw, layout)
            return []
        before = stage(before.distinct())  # the files are replaced below
        ingest(spark, raw, layout)
        months = upkeep.refresh(spark, from_bronze(spark, layout.bronze), layout.orders_base, before.unionByName(ids()))
        score_silver(spark, layout)
    return months


def build_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Segments, churn scores of all customers, and the metrics of both models."""
    orders = lake.read(spark, layout.silver_orders)
    scored = lake.read(spark, layout.gold("rfm_customers"))

    inputs = segments.kmeans_input(scored)
    segmentation = segments.fit(inputs)
    lake.write(segmentation.segments(inputs), layout.gold("customer_segments"))
    results.save_model(segmentation.model, layout.at("models", "kmeans_segmentation"))

    labelled = stage(churn_models.labelled_customers(stage(churn.churn_features(orders, scored))))
    model = churn_models.gradient_boosting(labelled)
    lake.write(model.scored(labelled), layout.gold("churn_predictions"))
    results.save_model(model.model, layout.at("models", "churn_classifier"))

    scores = {"GradientBoosting": model.scores(labelled)}
    found = results.result(
        "Churn_Prediction", scores, "GradientBoosting", model.confusion(labelled), model.importance(labelled)
    )
    performance = results.records(spark, [found])
    lake.write_documents(performance, layout.gold("model_performance"))
    return {
        "segments": segments.quality(segmentation, inputs),
        "churn": evaluation.metrics_table(spark, scores),
    }


def publish(spark: SparkSession, layout: Layout) -> None:
    """Documents, summaries and reports from the written layers; segments and predictions may be missing."""
    tables = from_bronze(spark, layout.bronze)
    orders = lake.read(spark, layout.silver_orders)
    scored = lake.read(spark, layout.gold("rfm_customers"))
    segmented = lake.read_optional(spark, layout.gold("customer_segments"))
    predicted = lake.read_optional(spark, layout.gold("churn_predictions"))

    lake.write_documents(documents.order_documents(orders), layout.documents("orders"))
    customers = documents.customer_documents(scored, segmented, predicted)
    lake.write_documents(customers, layout.documents("customers"))
    lake.write_documents(documents.product_documents(orders, tables), layout.documents("products"))
    lake.write_documents(documents.seller_documents(orders, tables), layout.documents("sellers"))
    performance = layout.gold("model_performance")
    models = results.read_records(spark, performance) if raw_csv.exists(spark, performance, "json") else None
    parts = documents.summaries(orders, segmented, models)
    aggregates = layout.gold("aggregates")
    collection.write(collection.collect_kinds(parts), aggregates)
    stored = collection.as_columns(collection.read(spark, aggregates), parts)
    lake.write_documents(documents.tagged_union(stored), layout.documents("aggregations"))
    lake.write_reports(reports.run(orders, scored), layout.at("reports"))


def run(spark: SparkSession, raw: Mapping[str, str], root: str) -> Layout:
    """Run all layers; intermediate tables are deleted at the end."""
    layout = Layout(root)
    with scope(spark):
        ingest(spark, raw, layout)
        build_silver(spark, layout)
        build_gold(spark, layout)
        publish(spark, layout)
    return layout
