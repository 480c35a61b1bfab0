"""Substring search by an index of trigrams instead of a look at every text.

A text, in lower case, is filed under each of its trigrams. Two marks behind its end give its last characters trigrams
too, so terms of one or two characters are prefixes of trigrams. A trigram's list holds the texts themselves: the list of
the term's rarest trigram is read, and each text in it verified.

Lists are sorted over all files by trigram and text. A trigram that a third of all texts share is therefore split among
files, and a search opens only the files and row groups whose range covers its trigram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.measures import rows
from souk.functions.text import contains_ignoring_case

SIZE = 3
END = "\x03"
#: Up to so many found texts are looked up by value, which reaches the scan; more are joined.
LOOKED_UP = 1_000


def _grams(text: Column) -> Column:
    """The distinct trigrams that begin at each character; an empty text has none."""
    padded = F.concat(text, F.lit(END * (SIZE - 1)))
    starts = F.sequence(F.lit(1), F.length(text))
    each = F.transform(starts, lambda at: F.substring(padded, at, F.lit(SIZE)))
    return F.array_distinct(F.when(F.length(text) > 0, each))


def build(df: DataFrame, column: str, path: str) -> None:
    """Index the distinct values of ``column`` at ``path``, in place of what is there. NULL and empty texts are found by
    no term and not filed."""
    texts = df.select(F.col(column).cast("string").alias("value")).filter(F.length("value") > 0).distinct()
    filed = texts.select(F.explode(_grams(F.lower("value"))).alias("gram"), "value")
    filed.repartitionByRange("gram", "value").sortWithinPartitions("gram", "value").write.mode("overwrite").parquet(
        f"{path}/lists"
    )
    counts = df.sparkSession.read.parquet(f"{path}/lists").groupBy("gram").agg(rows().alias("texts"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts")


def find(spark: SparkSession, path: str, term: str) -> DataFrame:
    """The distinct indexed values that contain ``term``, upper and lower case alike."""
    wanted = term.lower()
    lists = spark.read.schema("gram string, value string").parquet(f"{path}/lists")
    holds = contains_ignoring_case(F.col("value"), wanted)
    if len(wanted) < SIZE:
        return lists.filter(F.col("gram").startswith(wanted) & holds).select("value").distinct()
    grams = sorted({wanted[i : i + SIZE] for i in range(len(wanted) - SIZE + 1)})
    counts = spark.read.schema("gram string, texts long").parquet(f"{path}/counts")
    found = {r["gram"]: r["texts"] for r in counts.filter(F.col("gram").isin(grams)).collect()}
    rarest = min(grams, key=lambda g: found.get(g, 0))
    return lists.filter((F.col("gram") == rarest) & holds).select("value")


def search(df: DataFrame, column: str, path: str, term: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` contains ``term``, as ``rows.search`` finds them by looking at all; an empty term
    finds all rows."""
    if not term:
        return df
    spark, name = df.sparkSession, f"`{column}`"
    found = find(spark, path, term)
    few = [r["value"] for r in found.limit(LOOKED_UP + 1).collect()]
    if len(few) <= LOOKED_UP:
        kind = df.schema[column].dataType
        return df.filter(F.col(name).isin([F.lit(v).cast(kind) for v in few]) if few else F.lit(False))
    return df.join(found, F.col(name).cast("string") == F.col("value"), "left_semi")
