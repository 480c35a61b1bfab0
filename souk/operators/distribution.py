"""Histograms, capped columns and long-form summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators.ranking import exact_percentiles

#: A sketched percentile is off by one ACCURACY-th of all rows at most.
ACCURACY = 10_000


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins from the smallest to the largest value; the last bin is closed."""
    value = F.col(column).cast("double")
    present = df.filter(F.col(column).isNotNull()).select(value.alias("value"))
    ends = present.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high")).alias("ends")).scalar()
    low, width = ends.getField("low"), (ends.getField("high") - ends.getField("low")) / bins
    index = F.coalesce(F.floor(F.try_divide(F.col("value") - low, width)), F.lit(0))
    return (
        present.select(F.least(index, F.lit(bins - 1)).cast("int").alias("bin"), low.alias("low"), width.alias("width"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("row_count"), F.min("low").alias("low"), F.min("width").alias("width"))
        .select(
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_from"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_to"),
            "row_count",
        )
        .orderBy("bin")
    )


def capped(df: DataFrame, column: str, cap: float, name: str) -> DataFrame:
    return df.withColumn(name, F.least(F.col(column).cast("double"), F.lit(float(cap))))


def winsorised(df: DataFrame, column: str, point: float = 0.95) -> DataFrame:
    """Cap a column at its own percentile, as ``<column>_capped``."""
    cap = exact_percentiles(df, [column], [point])[column][point]
    name = f"{column}_capped"
    return df.withColumn(name, F.col(column).cast("double")) if cap is None else capped(df, column, cap, name)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, standard deviation, smallest and largest value: one row per column, one pass over the data."""
    per_column = []
    for c in columns:
        value = F.col(c).cast("double")
        per_column.append(
            F.struct(
                F.lit(c).alias("measure"),
                F.count(value).alias("row_count"),
                F.round(F.avg(value), 4).alias("mean"),
                F.round(F.stddev_samp(value), 4).alias("stddev"),
                F.round(F.min(value), 6).alias("smallest"),
                F.round(F.max(value), 6).alias("largest"),
            )
        )
    return df.agg(F.array(*per_column).alias("rows")).select(F.inline("rows"))


def approx_percentiles(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """Sketch-based percentiles in one pass, one row per column."""
    sketches = [F.percentile_approx(F.col(c).cast("double"), list(points), ACCURACY).alias(c) for c in columns]
    names = [f"p{round(p * 100)}" for p in points]
    long = df.agg(*sketches).unpivot([], list(columns), "measure", "values")
    return long.select("measure", *(F.get("values", F.lit(i)).alias(n) for i, n in enumerate(names)))


def approx_percentile_ranks(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """(measure, point, row_count, in_bounds): whether each sketched percentile's exact rank is as near to the wanted one
    as the sketch promises. One pass counts the rows below and up to each value; equal values are counted first."""
    names = [f"p{round(p * 100)}" for p in points]
    sketched = approx_percentiles(df, columns, points).unpivot(["measure"], names, "point", "value")
    wanted = F.element_at(F.create_map(*(F.lit(x) for pair in zip(names, points, strict=True) for x in pair)), F.col("point"))
    values = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).unpivot([], list(columns), "name", "x")
    counted = values.filter("x is not null").groupBy("name", "x").agg(F.count(F.lit(1)).alias("n"))
    # As many rows as there are columns and points.
    ranked = counted.join(F.broadcast(sketched), F.col("name") == F.col("measure")).groupBy("measure", "point", "value").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(F.col("x") < F.col("value"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("x") <= F.col("value"), F.col("n")).otherwise(0)).alias("upto"),
    )
    slack = F.col("row_count") / ACCURACY + 1
    place = wanted * F.col("row_count")
    within = (F.col("below") <= place + slack) & (F.col("upto") >= place - slack)
    return ranked.select("measure", "point", "row_count", within.alias("in_bounds"))
