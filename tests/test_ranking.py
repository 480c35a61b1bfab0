"""Ranks found by staged positions equal Spark's own single-task windows and aggregates."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from souk.operators.ordering import after, asc, desc
from souk.operators.ranking import distributed_ntile, exact_percentiles, ntile_starts
from souk.operators import rows
from souk.operators.rows import first_per_key, page, page_after, with_stratified_split


def values(kind, n):
    rng = random.Random(n)
    if kind == "distinct":
        return rng.sample(range(10 * n + 1), n)
    if kind == "one third equal":
        return [7 if i % 3 == 0 else rng.randrange(n) for i in range(n)]
    if kind == "all equal":
        return [5] * n
    return [None if i % 4 == 0 else rng.randrange(3) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 7, 1001])
@pytest.mark.parametrize("kind", ["distinct", "one third equal", "all equal", "with nulls"])
def test_ntile_equals_window(spark, n, kind):
    df = spark.createDataFrame(list(enumerate(values(kind, n))), "id int, x int").repartition(5)
    for key, order in ((desc("x"), F.desc("x")), (asc("x"), F.asc("x"))):
        ours = distributed_ntile(df, 4, [key, asc("id")])
        theirs = F.ntile(4).over(Window.orderBy(order, F.asc("id")))
        wrong = df.withColumn("a", ours).withColumn("b", theirs).filter(~F.col("a").eqNullSafe(F.col("b")))
        assert wrong.count() == 0


@given(st.integers(0, 500), st.integers(1, 20))
def test_bucket_sizes_differ_by_at_most_one(n, buckets):
    edges = [0, *ntile_starts(n, buckets), n]
    sizes = [b - a for a, b in zip(edges, edges[1:])]
    assert sum(sizes) == n
    assert sizes == sorted(sizes, reverse=True)
    assert max(sizes) - min(sizes) <= 1


def test_ntile_starts():
    assert ntile_starts(10, 4) == [3, 6, 8]
    assert ntile_starts(2, 4) == [1]
    assert ntile_starts(0, 4) == []


def test_percentiles_equal_exact_aggregate(spark):
    rows = [(float(v) if v is not None else None, i % 2) for i, v in enumerate(values("with nulls", 999))]
    df = spark.createDataFrame(rows, "x double, y int").repartition(4)
    points = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = exact_percentiles(df, ["x", "y"], points)
    for c in ("x", "y"):
        expected = df.agg(F.percentile(c, list(points)).alias("p")).first()["p"]
        assert [found[c][p] for p in points] == pytest.approx(expected)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_percentiles(df, ["x"], [0.5]) == {"x": {0.5: None}}


def test_after_follows_the_sort_order(spark):
    data = [(x, y) for x in (None, 1, 2) for y in (None, "a", "b")]
    df = spark.createDataFrame(data, "x int, y string")
    keys = [desc("x"), asc("y")]
    ordered = [r.asDict() for r in df.orderBy(*(k.sort() for k in keys)).collect()]
    for i, row in enumerate(ordered):
        assert df.filter(after(keys, row, inclusive=True)).count() == len(ordered) - i
        assert df.filter(after(keys, row, inclusive=False)).count() == len(ordered) - i - 1


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    picked = first_per_key(df, ["k"], [asc("id")])
    assert sorted(map(tuple, picked.collect())) == [(0, 0), (1, 1), (2, 2)]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_stratified_split_is_exact_in_each_stratum(spark):
    df = spark.range(103).select("id", (F.col("id") < 10).cast("double").alias("label"))
    split = with_stratified_split(df, "id", "label", 0.8).groupBy("label", "split").count().collect()
    counts = {(r["label"], r["split"]): r["count"] for r in split}
    assert counts == {(1.0, "train"): 8, (1.0, "test"): 2, (0.0, "train"): 74, (0.0, "test"): 19}


def test_any_number_of_strata_costs_one_plan(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 200).alias("label"))
    split = with_stratified_split(df, "id", "label", 0.5)
    counts = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    for (label, _), n in counts.items():
        whole = counts.get((label, "train"), 0) + counts.get((label, "test"), 0)
        assert counts.get((label, "train"), 0) == whole // 2, (label, n)
    assert sum(counts.values()) == 600 and split.columns == ["id", "label", "split"]
    assert "Union" not in split._jdf.queryExecution().executedPlan().toString()


def test_deep_pages_are_those_of_the_whole_order(spark, monkeypatch):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("x"))
    order = [desc("x"), asc("id")]
    shallow = [[tuple(r) for r in page(df, order, n, 30).collect()] for n in (1, 17, 34, 35)]
    monkeypatch.setattr(rows, "SHALLOW_ROWS", 0)
    deep = [page(df, order, n, 30) for n in (1, 17, 34, 35)]
    assert [[tuple(r) for r in p.collect()] for p in deep] == shallow
    assert "TakeOrdered" not in deep[2]._jdf.queryExecution().executedPlan().toString()


def test_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 4), (2, None)], "k int, x int")
    picked = first_per_key(df, ["k"], [asc("x", nulls_last=True)])
    assert sorted(map(tuple, picked.collect())) == [(1, 4), (2, None)]
    key = [asc("x", nulls_last=True)]
    assert df.filter(after(key, {"x": 4}, inclusive=False)).count() == 3
    assert df.filter(after(key, {"x": None}, inclusive=True)).count() == 2


def test_pages(spark):
    df = spark.range(25).select("id", (F.col("id") % 5).alias("x"))
    order = [desc("x"), asc("id")]
    first = page(df, order, 1, 10).collect()
    assert [r["id"] for r in first] == [4, 9, 14, 19, 24, 3, 8, 13, 18, 23]
    assert {(r["total_records"], r["total_pages"]) for r in first} == {(25, 3)}
    assert page(df, order, 4, 10).count() == 0
    second = [r["id"] for r in page(df, order, 2, 10).collect()]
    assert [r["id"] for r in page_after(df, order, first[-1].asDict(), 10).collect()] == second
