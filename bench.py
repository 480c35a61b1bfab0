"""Time the headline queries on one folder of test data and print one JSON line.

Every query starts from the Parquet files: nothing written or fitted for an earlier query is reused. Results go to
Spark's ``noop`` sink, so all rows and columns are computed and none is collected. ``ingest`` times the validation and
landing of raw CSV files (written beforehand, not timed); ``ml_run`` both model fits from prepared tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from souk import catalog  # noqa: E402
from souk.models import churn, segments  # noqa: E402
from souk.operators.staging import scope, stage  # noqa: E402
from souk.plans import lakehouse  # noqa: E402
from souk.session import local_session  # noqa: E402
from souk.sources import raw_csv, star  # noqa: E402

HEADLINE = (
    "monthly_revenue_growth",
    "overview_summary",
    "orders_by_status",
    "orders_by_state",
    "top_categories",
    "payment_methods",
    "delivery_overall",
    "merged_orders",
    "order_documents",
    "rfm_scores",
    "customer_documents",
    "product_stats",
    "seller_stats",
    "aggregations_union",
    "order_percentiles_exact",
    "dq_manifest_summary",
    "dq_null_profile",
    "latest_order_per_customer",
    "minmax_risk",
    "kmeans_segments",
    "churn_scored",
)
RAW_TABLES = (
    "orders",
    "order_items",
    "payments",
    "reviews",
    "customers",
    "products",
    "sellers",
    "category_translation",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def ml_run(customers, labelled) -> None:
    """Segments and churn model from prepared tables: both fits, their metrics, and scores of all customers."""
    found = segments.fit(customers)
    segments.quality(found, customers).collect()
    found.segments(customers).write.format("noop").mode("overwrite").save()
    model = churn.gradient_boosting(labelled)
    model.scores(labelled)
    model.scored(labelled).write.format("noop").mode("overwrite").save()


def write_raw(spark, root: str, folder: str) -> dict[str, str]:
    paths = {name: path for name, path in raw_csv.table_paths(folder).items() if name in RAW_TABLES}
    for name, df in star.from_star(spark, root).items():
        if name in paths:
            plain = df.selectExpr(
                *(f"date_format({c}, 'yyyy-MM-dd HH:mm:ss') as {c}" if "timestamp" in t else c for c, t in df.dtypes)
            )
            plain.repartition(8).write.option("header", True).option("escape", '"').csv(paths[name])
    return paths


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, "ml_run", "ingest"]
    spark = local_session("bench", cores)

    def run(name: str) -> None:
        catalog.forget()
        with scope(spark):
            catalog.run(name, spark, root).write.format("noop").mode("overwrite").save()

    run("monthly_revenue_growth")  # warm-up: class loading and code generation, not timed
    timings = {name: seconds(lambda name=name: run(name)) for name in names if name not in ("ml_run", "ingest")}
    customers = None
    if "ml_run" in names:
        catalog.forget()
        with scope(spark):
            shop = catalog.shop(spark, root)
            prepared, labelled = stage(shop.segment_rows), shop.labelled
            customers = prepared.count()
            timings["ml_run"] = seconds(lambda: ml_run(prepared, labelled))
    if "ingest" in names:
        folder = tempfile.mkdtemp(prefix="souk-bench-")
        paths = write_raw(spark, root, f"{folder}/raw")
        timings["ingest"] = seconds(lambda: lakehouse.ingest(spark, paths, lakehouse.Layout(f"{folder}/lake")))
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
                "ml_run_customers": customers,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
