"""Customer segments by k-means on standardised recency, frequency and monetary value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.labels import SEGMENTS, named
from souk.plans.rfm import CUSTOMER

INPUTS = ("recency", "frequency", "monetary")
CLUSTERS, ITERATIONS, SEED = 4, 30, 42


def kmeans_input(customers: DataFrame) -> DataFrame:
    """Customers whose three inputs are all known."""
    inputs = [F.col(c).cast("double").alias(c) for c in INPUTS]
    return customers.select(CUSTOMER, *inputs).na.drop(subset=list(INPUTS))


@dataclass(frozen=True)
class Segmentation:
    model: PipelineModel
    names: dict[int, str]

    def assign(self, inputs: DataFrame) -> DataFrame:
        clustered = self.model.transform(inputs)
        return clustered.withColumn("segment_name", named(F.col("cluster"), self.names))

    def segments(self, inputs: DataFrame) -> DataFrame:
        return self.assign(inputs).select(CUSTOMER, *INPUTS, "cluster", "segment_name")

    def silhouette(self, inputs: DataFrame) -> float:
        evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette")
        return evaluator.evaluate(self.model.transform(inputs))


def fit(inputs: DataFrame) -> Segmentation:
    """Clusters are named by the monetary value of their centre, highest first. Scaling keeps that order."""
    stages = [
        VectorAssembler(inputCols=list(INPUTS), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        KMeans(featuresCol="features", predictionCol="cluster", k=CLUSTERS, seed=SEED, maxIter=ITERATIONS),
    ]
    model = Pipeline(stages=stages).fit(inputs)
    spend = {i: centre[INPUTS.index("monetary")] for i, centre in enumerate(model.stages[-1].clusterCenters())}
    richest_first = sorted(spend, key=spend.get, reverse=True)
    return Segmentation(model, dict(zip(richest_first, SEGMENTS, strict=False)))


def quality(segmentation: Segmentation, inputs: DataFrame) -> DataFrame:
    sizes = segmentation.assign(inputs).groupBy("cluster", "segment_name").agg(F.count(F.lit(1)).alias("customers"))
    silhouette = F.lit(round(segmentation.silhouette(inputs), 4)).alias("silhouette")
    return sizes.select("cluster", "segment_name", "customers", silhouette)


# Checks that need no knowledge of how the clusters were found

#: How far, in standard deviations, a centre may lie from the mean of its rows when the iterations stop.
CENTRED = 0.01
AGREES = 1e-6


def _scaled(segmentation: Segmentation, inputs: DataFrame) -> DataFrame:
    """Inputs in standard deviations from their mean (0 where there is none), with the cluster of each row."""
    scaler = segmentation.model.stages[1]
    scaled = [
        ((F.col(c) - F.lit(float(m))) / F.lit(float(s)) if s else F.lit(0.0)).alias(f"x_{c}")
        for c, m, s in zip(INPUTS, scaler.mean, scaler.std, strict=True)
    ]
    return segmentation.assign(inputs).select("cluster", *scaled)


def cluster_sums(segmentation: Segmentation, inputs: DataFrame) -> DataFrame:
    """One row per cluster: rows, mean point, mean squared norm."""
    norm = sum(F.col(f"x_{c}") * F.col(f"x_{c}") for c in INPUTS)
    return _scaled(segmentation, inputs).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *(F.avg(f"x_{c}").alias(f"m_{c}") for c in INPUTS), F.avg(norm).alias("mean_norm")
    )


def checks(segmentation: Segmentation, inputs: DataFrame) -> DataFrame:
    """(customers, nearest, centred, silhouette_agrees): every row has its nearest centre, every centre is the mean of its
    rows, and the silhouette by sums per cluster equals the evaluator's. One row; true for no rows at all.

    The centres and sums of the few clusters are constants of the plan; rows are read once more and meet no other row.
    """
    centres = [list(map(float, c)) for c in segmentation.model.stages[-1].clusterCenters()]
    sums = {r["cluster"]: r for r in cluster_sums(segmentation, inputs).collect()}
    centred = all(abs(r[f"m_{c}"] - centres[k][i]) <= CENTRED for k, r in sums.items() for i, c in enumerate(INPUTS))

    point = [F.col(f"x_{c}") for c in INPUTS]
    to_centre = [sum((x - v) * (x - v) for x, v in zip(point, c, strict=True)) for c in centres]
    own_centre = F.element_at(F.array(*to_centre), F.col("cluster") + 1)
    nearest = own_centre <= F.array_min(F.array(*to_centre)) + AGREES

    norm = sum(x * x for x in point)
    mean_distance = {
        k: norm + r["mean_norm"] - 2 * sum(x * F.lit(r[f"m_{c}"]) for x, c in zip(point, INPUTS, strict=True))
        for k, r in sums.items()
    }
    width = F.lit(0.0)  # of a row alone in its cluster
    for k, r in sums.items():
        if r["n"] > 1:
            own = mean_distance[k] * F.lit(r["n"] / (r["n"] - 1))
            others = [d for other, d in mean_distance.items() if other != k]
            nearby = F.array_min(F.array(*others)) if others else own
            ratio = (nearby - own) / F.nullif(F.greatest(nearby, own), F.lit(0.0))
            width = F.when(F.col("cluster") == k, F.coalesce(ratio, F.lit(0.0))).otherwise(width)
    counted = _scaled(segmentation, inputs).agg(
        F.count(F.lit(1)).alias("customers"),
        F.coalesce(F.bool_and(nearest), F.lit(True)).alias("nearest"),
        F.lit(centred).alias("centred"),
        F.avg(width).alias("silhouette"),
    )
    alike = F.abs(F.col("silhouette") - F.lit(segmentation.silhouette(inputs) if len(sums) > 1 else 0.0)) <= AGREES
    return counted.select(
        "customers", "nearest", "centred", F.coalesce(alike, F.lit(True)).alias("silhouette_agrees")
    )
