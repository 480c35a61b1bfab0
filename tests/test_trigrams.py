"""The trigram index finds what a look at every text finds, and opens few files for it."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_plans import plan

from souk.operators import rows as pick
from souk.operators import trigrams

TEXTS = ["Abc", "abcabc", "xABx", "ab", "a", "", None, "abc", "Ünal.*", "a\x03b", "x%_y", "😀😀b", "aaaaaa", " abc "]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "n long, t string")


@pytest.fixture(scope="module")
def index(texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    trigrams.build(texts, "t", path)
    return path


def ids(df):
    return sorted(r["n"] for r in df.collect())


@pytest.mark.parametrize(
    "term", ["", "a", "AB", "abc", "BCA", "bcab", "nowhere", ".*", "%", "ün", "😀b", "\x03", "c\x03\x03", "aaaa", "x%_y", " "]
)
def test_equals_the_scan(texts, index, term):
    assert ids(trigrams.search(texts, "t", index, term)) == ids(pick.search(texts, "t", term))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text("abcxAB ", min_size=1, max_size=5))
def test_any_term(texts, index, term):
    assert ids(trigrams.search(texts, "t", index, term)) == ids(pick.search(texts, "t", term))


def test_many_hits_are_joined(texts, index, monkeypatch):
    monkeypatch.setattr(trigrams, "LOOKED_UP", 2)
    found = trigrams.search(texts, "t", index, "ab")
    assert "Join" in plan(found) and ids(found) == ids(pick.search(texts, "t", "ab"))


def test_numbers_are_searched_as_text(spark, tmp_path):
    df = spark.range(990, 1210).select(F.col("id").alias("n"))
    trigrams.build(df, "n", str(tmp_path))
    found = trigrams.search(df, "n", str(tmp_path), "12")
    assert ids(found) == [n for n in range(990, 1210) if "12" in str(n)]
    assert "In(n" in plan(found) or "INSET" in plan(found) or "IN (" in plan(found)


def test_empty_table(spark, texts, tmp_path):
    trigrams.build(texts.limit(0), "t", str(tmp_path))
    assert trigrams.find(spark, str(tmp_path), "abc").count() == trigrams.find(spark, str(tmp_path), "a").count() == 0


def test_a_hot_trigram_is_split_and_others_are_pruned(spark, tmp_path):
    """All texts share a trigram. Its list spans several files; a rare term opens few of them."""
    df = spark.range(30_000).select(F.concat(F.lit("id-"), F.sha2(F.col("id").cast("string"), 256)).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for large tables
    try:
        trigrams.build(df, "t", str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lists = spark.read.parquet(f"{tmp_path}/lists")
    file = F.input_file_name()
    everything = lists.select(file).distinct().count()
    rare = trigrams.find(spark, str(tmp_path), "id-00")
    assert rare.count() == df.filter("t like 'id-00%'").count()
    assert everything > 1 and lists.filter("gram = '-00'").select(file).distinct().count() < everything
    assert "EqualTo(gram,-00)" in plan(rare)
    ranges = lists.groupBy(file.alias("f")).agg(F.min("gram").alias("a"), F.max("gram").alias("b")).collect()
    covering = [r for r in ranges if r["a"] <= "-00" <= r["b"]]
    assert len(covering) < everything
