"""Every registered query, run on the star-schema stand-in below a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.categories import with_display_name
from souk.functions.dates import with_calendar
from souk.functions.measures import mean_of_ratios
from souk.models import churn as churn_models
from souk.models import evaluation, results, reviews, segments
from souk.operators import distribution, inference, quality, trigrams
from souk.operators import rows as pick
from souk.operators.ordering import asc, desc
from souk.operators.staging import stage, staged_path
from souk.plans import churn, collection, colocated, dashboard, documents, reports, rfm, rfm_upkeep, silver, sketches, upkeep
from souk.plans.rfm import CUSTOMER
from souk.sources import star
from souk.sources.contracts import CONTRACTS
from souk.sources.lake import portable

# Choices of the stand-in: a payment type that exists in it, a search term, a conversion rate.
STAND_IN_METHOD = "RO"
SEARCH_TERM = "12"
CONVERSION_RATE = 5140.0
LOOKUP_CUSTOMER = 42
AFTER_CUSTOMER = {"monetary": 1_000_000, CUSTOMER: 0}
CUSTOMER_SCORES = ("recency", "frequency", "monetary", "rfm_score")


def flat(df: DataFrame) -> DataFrame:
    """Result columns any SQL engine can print: decimals as double, timestamps as text, arrays joined."""
    out = []
    plain = portable(df)
    for f in plain.schema.fields:
        c = F.col(f.name)
        kind = f.dataType.typeName()
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "array":
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return plain.select(*out)


class Shop:
    """The tables of one folder. Silver is a lazy plan; the scored customers are written once, as gold tables are."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.tables = star.from_star(spark, root)

    @cached_property
    def merged(self) -> DataFrame:
        return silver.written_orders(self.tables)

    @cached_property
    def orders(self) -> DataFrame:
        """The plan whose unused parts vanish, for reports."""
        return silver.order_features(silver.clean_orders(silver.merged_orders_by_part(self.tables)))

    @cached_property
    def wide(self) -> DataFrame:
        """The plan for all columns."""
        return silver.order_features(silver.clean_orders(self.merged))

    @cached_property
    def written(self) -> DataFrame:
        """The silver columns that summaries and item joins read, as a written table, with those of customer figures, which
        stand in the same parts. They need product and seller of an order's first item only, so the plan by parts sends
        one row per order, not every item, to these lookups."""
        columns = dict.fromkeys(("order_id", "seller_state", *documents.SUMMARY_COLUMNS, *rfm.INPUT_COLUMNS))
        return stage(self.orders.select(*columns))

    @cached_property
    def purchases(self) -> DataFrame:
        return with_calendar(star.purchases_from_events(self.spark, self.root), "order_purchase_timestamp")

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm.rfm_customers(self.orders)

    @cached_property
    def model_orders(self) -> DataFrame:
        """The order columns that all models read, as a written table: customer figures, the legacy features and the review
        rows would each join and aggregate all tables anew."""
        return stage(self.orders.select(*dict.fromkeys((*rfm.INPUT_COLUMNS, *reviews.COLUMNS))))

    @cached_property
    def customer_orders(self) -> DataFrame:
        """The order columns that customer figures read, as a written table: the features read them after the scores, and
        would join and aggregate all tables anew. Scores alone gain nothing from it (``rfm_scores`` does without). They are
        taken from a wider written table where there is one already."""
        for wider in ("model_orders", "written"):
            if wider in self.__dict__:
                return getattr(self, wider).select(*rfm.INPUT_COLUMNS)
        return stage(self.orders.select(*rfm.INPUT_COLUMNS))

    @cached_property
    def scored(self) -> DataFrame:
        return stage(rfm.with_scores(rfm.rfm_customers(self.customer_orders)))

    @cached_property
    def orders_scored(self) -> DataFrame:
        return rfm.orders_with_rfm(self.orders, self.scored)

    @cached_property
    def features(self) -> DataFrame:
        return churn.churn_features(self.customer_orders, self.scored)

    @cached_property
    def customers(self) -> DataFrame:
        """The customer documents as a written table, as the dashboard reads them."""
        return stage(self.customer_documents)

    @cached_property
    def customer_documents(self) -> DataFrame:
        """Customer documents whose segment and prediction follow fixed rules, so that SQL can check what is built
        on them: the segment by score, the probability by the composite risk."""
        score = F.col("rfm_score")
        by_score = labels.first_match(
            [(score <= 5, "Champions"), (score <= 7, "Loyal"), (score <= 9, "At Risk")], "Lost"
        )
        rank = F.lit(3) - sum((score <= limit).cast("int") for limit in (5, 7, 9))
        ruled = self.scored.select(CUSTOMER, rank.alias("cluster"), by_score.alias("segment_name"))
        risk = churn.with_risk(self.features).select(
            CUSTOMER, F.col("label").alias("prediction"), F.round("risk", 6).alias("churn_probability")
        )
        return documents.customer_documents(self.scored, ruled, risk)

    @cached_property
    def products(self) -> DataFrame:
        return documents.product_documents(self.written, self.tables)

    @cached_property
    def sketched(self) -> DataFrame:
        """The sketches by month and state as a written table, as gold keeps them."""
        return stage(sketches.month_state_sketches(self.orders))

    # Models

    @cached_property
    def formula_predictions(self) -> DataFrame:
        """The composite risk as a classifier of customers who did not buy for 90 days: a scorer that SQL can follow."""
        scored = churn.with_risk(self.features).drop("label")
        return scored.select(
            (F.col("recency") > 90).cast("double").alias("label"),
            (F.col("risk") > 0.5).cast("double").alias("prediction"),
            F.round("risk", 6).alias("rawPrediction"),
        )

    @cached_property
    def formula_scores(self) -> dict[str, dict[str, float]]:
        return {"RiskFormula": evaluation.classification_scores(self.formula_predictions)}

    @cached_property
    def formula_records(self) -> DataFrame:
        """Its figures as the record of a model family."""
        found = results.result("Churn_Prediction", self.formula_scores, "RiskFormula")
        return results.records(self.spark, [found])

    @cached_property
    def segment_rows(self) -> DataFrame:
        return segments.kmeans_input(self.scored)

    @cached_property
    def segmentation(self) -> segments.Segmentation:
        return segments.fit(self.segment_rows)

    @cached_property
    def labelled(self) -> DataFrame:
        return stage(churn_models.labelled_customers(stage(self.features)))

    @cached_property
    def stratified(self) -> DataFrame:
        return stage(churn_models.stratified_customers(self.customers))

    @cached_property
    def legacy(self) -> DataFrame:
        orders = self.model_orders  # before the scores, which read it too
        return stage(churn_models.legacy_features(rfm.orders_with_rfm(orders, self.scored)))

    @cached_property
    def review_rows(self) -> DataFrame:
        return stage(reviews.review_rows(self.model_orders if "model_orders" in self.__dict__ else self.orders))

    @cached_property
    def boosted(self) -> churn_models.Churn:
        return churn_models.gradient_boosting(self.labelled)

    @cached_property
    def forest(self) -> churn_models.Churn:
        return churn_models.random_forest(self.legacy)

    @cached_property
    def logistic(self) -> churn_models.Churn:
        return churn_models.logistic_regression(self.legacy)

    @cached_property
    def review_forest(self) -> reviews.ReviewModel:
        return reviews.random_forest(self.review_rows)

    @cached_property
    def review_line(self) -> reviews.ReviewModel:
        return reviews.linear_regression(self.review_rows)

    @cached_property
    def churn_scores(self) -> dict[str, dict[str, float]]:
        legacy = self.legacy  # first, so that the boosted model's customers come from the order columns written for it
        return {
            "GradientBoosting": self.boosted.scores(self.labelled),
            "RandomForest": self.forest.scores(legacy),
            "LogisticRegression": self.logistic.scores(legacy),
        }

    @cached_property
    def model_records(self) -> DataFrame:
        best = max(self.churn_scores, key=lambda name: self.churn_scores[name]["auc_roc"])
        review_scores = {
            "RandomForest": self.review_forest.scores(self.review_rows),
            "LinearRegression": self.review_line.scores(self.review_rows),
        }
        return results.records(
            self.spark,
            [
                results.result(
                    "Churn_Prediction",
                    self.churn_scores,
                    best,
                    self.boosted.confusion(self.labelled),
                    self.boosted.importance(self.labelled),
                ),
                results.result(
                    "Review_Prediction", review_scores, min(review_scores, key=lambda m: review_scores[m]["rmse"])
                ),
            ],
        )


Query = Callable[[Shop], DataFrame]


# Data quality


def _contracted(s: Shop) -> dict:
    return {name: (df, CONTRACTS[name]) for name, df in s.tables.items()}


def inferred_schema(s: Shop) -> DataFrame:
    """The tables as raw files hold them, all text, with the types that can be read off the values."""
    return inference.inferred_schema({name: (inference.as_text(df), c) for name, (df, c) in _contracted(s).items()})


def dq_duplicate_keys(s: Shop) -> DataFrame:
    parts = [
        quality.duplicate_keys(df, contract.key).select(F.lit(name).alias("table_name"), "key_count", "duplicate_keys")
        for name, (df, contract) in _contracted(s).items()
        if contract.key
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dq_verdict(s: Shop) -> DataFrame:
    return quality.manifest(_contracted(s)).select("table_name", "row_count", "duplicate_keys", "errors", "valid")


def dq_contract_orders(s: Shop) -> DataFrame:
    """Order documents whose id is text as required, and whose customer ids are numbers, which the contract warns of."""
    typed = s.orders.withColumn("order_id", F.col("order_id").cast("string"))
    return quality.contract_violations(documents.order_documents(typed), quality.DOCUMENT_RULES["orders"])


def _contract(df: DataFrame, kind: str) -> DataFrame:
    return quality.contract_violations(df, quality.DOCUMENT_RULES[kind])


def dq_rows_removed(s: Shop) -> DataFrame:
    twice = s.tables.orders.unionByName(s.tables.orders.filter(F.col("order_status") == "shipped"))
    merged = silver.merged_orders(_with_orders(s, twice))
    return quality.rows_removed(twice, silver.dedup_orders(twice), silver.clean_orders(merged))


def _with_orders(s: Shop, orders: DataFrame):
    return replace(s.tables, orders=orders)


def churn_label_share(s: Shop) -> DataFrame:
    return quality.group_shares(s.orders_scored, "churn")


# Silver


def order_documents(s: Shop) -> DataFrame:
    """The nested documents, with each nested field named ``part__field``."""
    nested = documents.order_documents(s.wide)
    parts = [
        F.col(f"{part}.{field}").alias(f"{part}__{field}")
        for part, fields in documents.ORDER_PARTS.items()
        for field in fields
    ]
    rest = [c for c in nested.columns if c not in documents.ORDER_PARTS]
    return nested.select(*rest, *parts)


def dedup_orders(s: Shop) -> DataFrame:
    """Orders with every shipped one repeated a day later and every delivered one without a date; the earlier row of
    each pair stays, and the dated one."""
    at = F.col("order_purchase_timestamp")
    later = s.tables.orders.filter(F.col("order_status") == "shipped").withColumn(
        "order_purchase_timestamp", F.date_add(at, 1).cast("timestamp_ntz")
    )
    undated = s.tables.orders.filter(F.col("order_status") == "delivered").withColumn(
        "order_purchase_timestamp", F.lit(None).cast("timestamp_ntz")
    )
    kept = silver.dedup_orders(s.tables.orders.unionByName(later).unionByName(undated))
    return kept.select("order_id", "customer_id", "order_status", "order_purchase_timestamp")


def order_features(s: Shop) -> DataFrame:
    return s.orders.select(
        "order_id",
        "delivery_days",
        "estimated_vs_actual",
        "freight_ratio",
        "order_value",
        "delivery_status",
        "satisfaction_level",
    )


def purchase_calendar(s: Shop) -> DataFrame:
    fields = ("hour", "dayofweek", "month", "year", "quarter", "year_month")
    return s.purchases.select("order_id", *(f"purchase_{f}" for f in fields))


def colocated_orders(s: Shop) -> DataFrame:
    """The wide order row from tables written in buckets of the order id."""
    root = staged_path(s.spark)
    n_buckets = colocated.bucket_count(s.tables, int(s.spark.conf.get("spark.sql.shuffle.partitions")))
    colocated.write(s.tables, root, n_buckets)
    return colocated.merged_orders(colocated.read(s.spark, root, n_buckets))


def rfm_scores_folded(s: Shop) -> DataFrame:
    """Customer scores from three batches of orders. Dates are mixed, so the later batches bring late orders."""
    root = staged_path(s.spark)
    orders = stage(s.orders.select(*rfm_upkeep.ORDER_COLUMNS))
    for batch in range(3):
        rfm_upkeep.fold(s.spark, root, orders.filter(F.pmod(F.xxhash64("order_id"), F.lit(3)) == batch), batch)
    return rfm_upkeep.scored(s.spark, root)


def parse_timestamps(s: Shop) -> DataFrame:
    """Timestamps read from text; every tenth text is not a date and becomes NULL."""
    at = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("order_id") % 10 == 0, F.lit("not a date")).otherwise(at)
    typed = silver.with_parsed_timestamps(
        s.tables.orders.select("order_id", text.alias("order_approved_at")), ["order_approved_at"]
    )
    return typed.withColumn("parsed_year", F.year("order_approved_at"))


def churn_flag(s: Shop) -> DataFrame:
    return s.orders_scored.select("order_id", CUSTOMER, "recency", "churn")


def product_category_join(s: Shop) -> DataFrame:
    joined = silver.translated_products(s.tables.products, s.tables.category_translation)
    return joined.select("product_id", "product_category_name", "product_category_name_english")


# Dashboard


def indexed_search(s: Shop) -> DataFrame:
    """The customers of ``search_customers``, by an index of the ids' trigrams."""
    path = staged_path(s.spark)
    trigrams.build(s.customers, CUSTOMER, path)
    return dashboard.customer_rows(trigrams.search(s.customers, CUSTOMER, path, SEARCH_TERM), "frequency")


def kpi_overview(s: Shop) -> DataFrame:
    return dashboard.kpi_overview(s.orders, s.rfm, s.tables.sellers)


def category_display_name(s: Shop) -> DataFrame:
    categories = s.tables.category_translation.select("product_category_name_english")
    return with_display_name(categories, "product_category_name_english")


def revenue_converted(s: Shop) -> DataFrame:
    return dashboard.converted(
        dashboard.revenue_series(s.orders), "order_revenue", CONVERSION_RATE, "converted_revenue"
    )


def aggregations_union(s: Shop) -> DataFrame:
    """Five summaries of the same orders: the columns they use are written once and read five times."""
    return documents.aggregations_union(s.written, s.customers, s.formula_records)


def aggregation_documents(s: Shop) -> DataFrame:
    """The same summaries as documents of one collection, written, read back, and laid out as columns again."""
    parts = documents.summaries(s.written, s.customers, s.formula_records)
    path = staged_path(s.spark)
    collection.write(collection.collect_kinds(parts), path)
    return documents.tagged_union(collection.as_columns(collection.read(s.spark, path), parts))


def _mixed_documents(s: Shop) -> DataFrame:
    """Order documents of which one in a thousand has a text for its value, as only a schemaless collection can."""
    typed = documents.order_documents(s.orders.withColumn("order_id", F.col("order_id").cast("string")))
    right, wrong = (
        F.to_variant_object(F.struct(*(value if c == "order_value" else F.col(c) for c in typed.columns)))
        for value in (F.col("order_value"), F.lit("n/a").alias("order_value"))
    )
    spoilt = F.col("order_id").cast("long") % 1000 == 1
    return typed.select(F.when(spoilt, wrong).otherwise(right).alias(collection.DOCUMENT))


def dq_contract_variants(s: Shop) -> DataFrame:
    return collection.violations(_mixed_documents(s), quality.DOCUMENT_RULES["orders"], merged=False)


def dq_document_types(s: Shop) -> DataFrame:
    return collection.found_types(_mixed_documents(s), ("order_id", "order_value", "delivery_days", "items", "nowhere"))


def monetary_winsorised(s: Shop) -> DataFrame:
    return distribution.winsorised(s.rfm, "monetary").select(
        CUSTOMER, F.round("monetary_capped", 6).alias("monetary_capped")
    )


def stratified_split(s: Shop) -> DataFrame:
    return s.stratified.select(CUSTOMER, "label", "split")


# Models


def formula_metrics(s: Shop) -> DataFrame:
    return evaluation.metrics_table(s.spark, s.formula_scores)


def category_mean_metrics(s: Shop) -> DataFrame:
    """Errors of predicting an order's review score by the mean of its category."""
    rows = s.review_rows.select("order_id", reviews.CATEGORY, reviews.LABEL)
    means = rows.groupBy(reviews.CATEGORY).agg(mean_of_ratios(reviews.LABEL).alias("prediction"))
    predicted = rows.join(means, reviews.CATEGORY)
    return evaluation.metrics_table(s.spark, {"CategoryMean": evaluation.regression_scores(predicted, reviews.LABEL)})


def confusion_totals(s: Shop) -> DataFrame:
    """Test rows of each label, summed from the boosted model's confusion matrix."""
    return s.boosted.confusion(s.labelled).groupBy("label").agg(F.sum("row_count").alias("row_count"))


def formula_auc(s: Shop) -> DataFrame:
    area = evaluation.rank_area(s.formula_predictions)
    return area.withColumn("auc", F.round("auc", 9))


def refreshed_silver(s: Shop) -> DataFrame:
    """The silver table built without every other order bought in 1999 or later, then
    brought up to date with it: equal to the table built at once, and older months keep their files."""
    late = s.tables.orders.filter(F.col("order_purchase_timestamp") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    odd = late.select("order_id").filter(F.col("order_id") % 2 == 1)
    path = staged_path(s.spark)
    early = silver.silver_orders(s.tables, lambda df: df.join(odd, "order_id", "left_anti"))
    upkeep.write_by_month(early, path)
    upkeep.refresh(s.spark, s.tables, path, odd)
    orders = upkeep.read_by_month(s.spark, path)
    return orders.select("order_id", "purchase_year_month", "total_items", "total_payment_value", "review_score", "order_value")


def model_table_formula(s: Shop) -> DataFrame:
    """The model page's row of the composite risk, whose figures SQL can compute too."""
    table = results.model_table(s.formula_records)
    return table.select("name", "is_regression", "accuracy", "precision", "recall", "f1", "auc", "rmse")


def churn_scored_v2(s: Shop) -> DataFrame:
    return churn_models.slow_gradient_boosting(s.stratified).scored(s.stratified)


def churn_metrics(s: Shop) -> DataFrame:
    return evaluation.metrics_table(s.spark, s.churn_scores)


def model_table(s: Shop) -> DataFrame:
    return results.model_table(s.model_records)


def single_model(model: str, data: str) -> Query:
    return lambda s: evaluation.metrics_table(s.spark, {model: getattr(s, model).scores(getattr(s, data))})


QUERIES: dict[str, Query] = {
    # sources and data quality
    "scan_orders": lambda s: s.tables.orders.select("order_id", "customer_id", "order_status"),
    "dq_table_profile": lambda s: quality.table_profile(dict(s.tables.items())),
    "dq_null_counts": lambda s: quality.null_counts(_contracted(s)),
    "dq_null_profile": lambda s: quality.null_profile(s.merged),
    "inferred_schema": inferred_schema,
    "refreshed_silver": refreshed_silver,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_verdict": dq_verdict,
    "dq_contract_orders": dq_contract_orders,
    "dq_contract_variants": dq_contract_variants,
    "dq_document_types": dq_document_types,
    "dq_contract_customers": lambda s: _contract(s.customers, "customers"),
    "dq_contract_products": lambda s: _contract(s.products, "products"),
    "dq_contract_sellers": lambda s: _contract(documents.seller_documents(s.written, s.tables), "sellers"),
    "dq_manifest_summary": lambda s: quality.manifest_summary(quality.manifest(_contracted(s))),
    "dq_rows_removed": dq_rows_removed,
    "describe_order_metrics": lambda s: reports.describe_orders(s.orders),
    "describe_customer_scores": lambda s: distribution.describe(s.scored, CUSTOMER_SCORES),
    "churn_label_share": churn_label_share,
    # silver
    "payments_per_order": lambda s: silver.payments_per_order(s.tables.payments),
    "reviews_per_order": lambda s: silver.reviews_per_order(s.tables.reviews),
    "items_per_order": lambda s: silver.items_per_order(s.tables),
    "product_category_join": product_category_join,
    "items_enriched": lambda s: silver.items_enriched(s.tables),
    "dedup_orders": dedup_orders,
    "merged_orders": lambda s: s.merged,
    "colocated_orders": colocated_orders,
    "clean_orders": lambda s: silver.clean_orders(s.merged),
    "order_features": order_features,
    "purchase_calendar": purchase_calendar,
    "parse_timestamps": parse_timestamps,
    "project_order_summary": lambda s: documents.order_summary(s.orders),
    # customers
    "rfm_customers": lambda s: s.rfm,
    "rfm_scores": lambda s: rfm.rfm_scores(s.orders).select(
        CUSTOMER, "recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score"
    ),
    "rfm_scores_folded": rfm_scores_folded,
    "orders_with_rfm": lambda s: s.orders_scored.select("order_id", CUSTOMER, *rfm.ORDER_COLUMNS),
    "churn_flag": churn_flag,
    # reports
    "overview_summary": lambda s: reports.overview_summary(s.orders),
    "order_percentiles_exact": lambda s: reports.order_percentiles(s.orders),
    "order_percentiles_approx": lambda s: reports.order_percentiles_approx(s.orders),
    "order_percentiles_approx_ranks": lambda s: reports.order_percentiles_approx_ranks(s.orders),
    "orders_by_status": lambda s: reports.orders_by_status(s.orders),
    "monthly_revenue": lambda s: reports.monthly_revenue(s.orders),
    "monthly_revenue_growth": lambda s: reports.monthly_revenue_growth(s.orders),
    "orders_by_state": lambda s: reports.orders_by_state(s.orders),
    "review_distribution": lambda s: reports.review_distribution(s.orders),
    "review_average": lambda s: reports.review_average(s.orders),
    "review_by_delivery_status": lambda s: reports.review_by_delivery_status(s.orders),
    "category_revenue": lambda s: reports.category_revenue(s.orders),
    "top_categories": lambda s: reports.top_categories(s.orders),
    "bottom_categories": lambda s: reports.bottom_categories(s.orders),
    "category_count": lambda s: reports.category_count(s.orders),
    "category_mean_review": lambda s: reports.category_mean_review(s.orders),
    "payment_methods": lambda s: reports.payment_methods(s.orders),
    "installment_histogram": lambda s: reports.installment_histogram(s.orders, STAND_IN_METHOD),
    "delivery_overall": lambda s: reports.delivery_overall(s.orders),
    "delivery_buckets": lambda s: reports.delivery_buckets(s.orders),
    "delivery_by_state": lambda s: reports.delivery_by_state(s.orders),
    "slowest_states": lambda s: reports.slowest_states(s.orders),
    "delivery_days_histogram": lambda s: distribution.histogram(s.orders, "delivery_days", 10),
    "orders_by_hour": lambda s: reports.orders_by_hour(s.purchases),
    "orders_by_weekday": lambda s: reports.orders_by_weekday(s.purchases),
    "weekday_hour_heatmap": lambda s: dashboard.monday_first_heatmap(s.purchases),
    "rfm_frequency_distribution": lambda s: reports.rfm_frequency_distribution(s.rfm),
    "rfm_score_distribution": lambda s: reports.rfm_score_distribution(s.scored),
    "repeat_customer_rate": lambda s: reports.repeat_customer_rate(s.rfm),
    # documents and summaries
    "order_documents": order_documents,
    "customer_documents": lambda s: s.customer_documents,
    "product_reviews": lambda s: documents.product_reviews(s.written, s.tables.order_items),
    "product_stats": lambda s: s.products,
    "seller_metrics": lambda s: documents.seller_metrics(s.written, s.tables.order_items),
    "seller_stats": lambda s: documents.seller_documents(s.written, s.tables),
    "gold_monthly": lambda s: documents.gold_monthly(s.orders),
    "gold_category": lambda s: documents.gold_category(s.orders),
    "gold_state": lambda s: documents.gold_state(s.orders),
    "gold_hourly": lambda s: documents.gold_hourly(s.purchases),
    "gold_payment": lambda s: documents.gold_payment(s.orders),
    "segment_stats": lambda s: documents.segment_stats(s.customers),
    "aggregations_union": aggregations_union,
    "aggregation_documents": aggregation_documents,
    "sketched_customers": lambda s: sketches.checked_customers(s.orders, s.sketched),
    "sketched_returning": lambda s: sketches.checked_returning(s.orders, s.sketched),
    "sketched_percentiles": lambda s: sketches.checked_percentiles(s.orders, s.sketched),
    # dashboard
    "kpi_overview": kpi_overview,
    "revenue_series_order_value": lambda s: dashboard.revenue_series(s.orders),
    "revenue_converted": revenue_converted,
    "category_display_name": category_display_name,
    "top20_categories": lambda s: dashboard.top20_categories(s.orders),
    "category_from_products": lambda s: dashboard.category_from_products(s.products),
    "category_radar": lambda s: dashboard.category_radar(dashboard.top20_categories(s.orders)),
    "category_price_review": lambda s: dashboard.category_price_review(dashboard.top20_categories(s.orders)),
    "segment_distribution": lambda s: dashboard.segment_distribution(s.customers),
    "rfm_sample": lambda s: dashboard.rfm_sample(s.customers),
    "rfm_fraction_sample": lambda s: pick.fraction_sample(s.scored, CUSTOMER, 500),
    "top_customers": lambda s: dashboard.top_customers(s.customers),
    "segment_cohort_trend": lambda s: dashboard.segment_cohort_trend(s.customers),
    "segment_month_matrix": lambda s: dashboard.segment_month_matrix(s.customers),
    "segment_revenue": lambda s: dashboard.segment_revenue(s.customers),
    "segment_radar": lambda s: dashboard.segment_radar(s.customers),
    "churn_rate": lambda s: dashboard.churn_rate(s.customers),
    "churn_by_segment": lambda s: dashboard.churn_by_segment(s.customers),
    "high_risk_customers": lambda s: dashboard.high_risk_customers(s.customers),
    "churn_by_state": lambda s: dashboard.churn_by_state(s.customers),
    "review_histogram": lambda s: dashboard.review_histogram(s.orders),
    "top_states": lambda s: dashboard.top_states(s.orders),
    "state_revenue_from_customers": lambda s: dashboard.state_revenue_from_customers(s.customers),
    "payment_totals": lambda s: dashboard.payment_totals(s.orders),
    "logistics_kpis": lambda s: dashboard.logistics_kpis(s.orders),
    "delivery_status_counts": lambda s: dashboard.delivery_status_counts(s.orders),
    "satisfaction_counts": lambda s: dashboard.satisfaction_counts(s.orders),
    "state_delivery": lambda s: dashboard.state_delivery(s.orders),
    "review_impact": lambda s: dashboard.review_impact(s.orders),
    "search_customers": lambda s: dashboard.search_customers(s.customers, SEARCH_TERM),
    "indexed_search": indexed_search,
    "customers_page": lambda s: dashboard.customers_page(s.customers, 3, 10, SEARCH_TERM),
    "churn_page": lambda s: dashboard.churn_page(s.customers, 2, 25),
    "customers_after": lambda s: dashboard.next_customers(s.customers, AFTER_CUSTOMER, 10),
    "customer_lookup": lambda s: dashboard.customer_lookup(s.customers, LOOKUP_CUSTOMER),
    "latest_order_per_customer": lambda s: dashboard.latest_order_per_customer(s.orders),
    # churn risk
    "churn_features": lambda s: s.features,
    "risk_score": lambda s: churn.with_risk(s.features).select(CUSTOMER, F.round("risk", 6).alias("risk"), "label"),
    "minmax_risk": lambda s: churn.minmax_risk(s.customers).select(CUSTOMER, "risk", "label"),
    "risk_score_serving": lambda s: churn.serving_scores(s.customers),
    "risk_levels": lambda s: churn.risk_levels(churn.serving_scores(s.customers)),
    "class_weights": lambda s: churn.class_weights(churn.with_risk(s.features)),
    "train_test_split": lambda s: pick.with_split(s.features, CUSTOMER).select(CUSTOMER, "split"),
    "stratified_split": stratified_split,
    "monetary_winsorised": monetary_winsorised,
    # models
    "kmeans_input": lambda s: s.segment_rows,
    "kmeans_segments": lambda s: s.segmentation.segments(s.segment_rows),
    "kmeans_quality": lambda s: segments.quality(s.segmentation, s.segment_rows),
    "kmeans_checks": lambda s: segments.checks(s.segmentation, s.segment_rows),
    "churn_scored": lambda s: s.boosted.scored(s.labelled),
    "churn_scored_v2": churn_scored_v2,
    "churn_metrics": churn_metrics,
    "formula_metrics": formula_metrics,
    "category_mean_metrics": category_mean_metrics,
    "confusion_totals": confusion_totals,
    "model_or_formula_scores": lambda s: churn_models.served(s.customers, s.boosted),
    "formula_auc": formula_auc,
    "model_table_formula": model_table_formula,
    "confusion_matrix": lambda s: s.boosted.confusion(s.labelled),
    "feature_importance": lambda s: s.boosted.importance(s.labelled),
    "churn_rf": single_model("forest", "legacy"),
    "churn_lr": single_model("logistic", "legacy"),
    "review_rf": single_model("review_forest", "review_rows"),
    "review_lr": single_model("review_line", "review_rows"),
    "best_model": lambda s: evaluation.best_model(churn_metrics(s), "auc_roc"),
    "model_metrics_json": lambda s: s.model_records,
    "model_table": model_table,
}

_shops: dict[tuple[str, str], Shop] = {}


def shop(spark: SparkSession, root: str) -> Shop:
    """One ``Shop`` per application and folder, so that written tables and fitted models are built once."""
    key = spark.sparkContext.applicationId, root
    if key not in _shops:
        _shops[key] = Shop(spark, root)
    return _shops[key]


def forget() -> None:
    _shops.clear()


def run(name: str, spark: SparkSession, root: str) -> DataFrame:
    result = QUERIES[name](shop(spark, root))
    return result if name == "model_table" else flat(result)
