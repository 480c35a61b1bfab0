"""Choosing rows: one per key, samples, splits, pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.text import contains_ignoring_case
from souk.operators.ordering import Key, after, asc, sort_columns
from souk.operators.ranking import PART, PART_SHIFT, ROW_ID, range_sorted


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Key]) -> DataFrame:
    """Keep the first row of each key under ``order``.

    Spark limits each key to one row before the shuffle (a group-limit window), so a key that holds a large part of
    the table sends at most one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """The smallest row of each key. As an aggregate it is known to be unique on the key, so a left join to it
    disappears from plans that use none of its columns."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("row")).select(key, "row.*")


def digest(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def hash_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """A random-looking sample of ``size`` rows that is the same on every run and for every partitioning."""
    return df.orderBy(digest(key), F.col(key)).limit(size)


def hash_bucket(key: str, buckets: int = 100) -> Column:
    """0 .. buckets-1 from the first eight hex digits of the key's MD5."""
    return F.conv(F.substring(digest(key), 1, 8), 16, 10).cast("long") % buckets


def fraction_sample(df: DataFrame, key: str, size: int, buckets: int = 1_000_000) -> DataFrame:
    """About ``size`` rows: those whose key's hash falls into that share of all buckets, whatever the partitioning."""
    rows = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    return df.filter(hash_bucket(key, buckets) < F.floor(F.least(F.lit(1.0), F.lit(float(size)) / rows) * buckets))


def with_split(df: DataFrame, key: str, train_percent: int = 80) -> DataFrame:
    """Mark rows as train or test by the key alone: the same rows on every run and on every cluster."""
    return df.withColumn("split", F.when(hash_bucket(key) < train_percent, "train").otherwise("test"))


def with_stratified_split(df: DataFrame, key: str, stratum: str, train_share: float = 0.8) -> DataFrame:
    """Split each stratum exactly at ``train_share`` of its rows, in the order of the key's MD5.

    Rows are sorted by stratum and hash over all tasks; in a sorted partition the rows of a stratum are consecutive, so
    a row's position follows from where its stratum begins there. Any number of strata costs the same plan.
    """
    keys = [asc(stratum), asc("_digest"), asc(key)]
    part = F.shiftright(F.col(ROW_ID), PART_SHIFT)
    ordered = range_sorted(df.withColumn("_digest", digest(key)), keys).withColumn(PART, part)
    pieces = ordered.groupBy(F.col(stratum).alias("_stratum"), F.col(PART).alias("_piece")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(ROW_ID).alias("_first")
    )
    of_stratum = Window.partitionBy("_stratum")
    before = F.sum("_rows").over(of_stratum.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    placed = pieces.withColumns(
        {"_before": F.coalesce(before, F.lit(0)), "_total": F.sum("_rows").over(of_stratum)}
    ).drop("_rows")
    position = F.col("_before") + F.col(ROW_ID) - F.col("_first")
    return (
        ordered.join(placed, F.col(stratum).eqNullSafe(F.col("_stratum")) & (F.col(PART) == F.col("_piece")))
        .withColumn("split", F.when(position < F.floor(F.col("_total") * train_share), "train").otherwise("test"))
        .select(*df.columns, "split")
    )


def search(df: DataFrame, column: str, term: str) -> DataFrame:
    return df.filter(contains_ignoring_case(F.col(column), term)) if term else df


#: A page that ends behind so many rows is found by position instead of by the best rows of each task.
SHALLOW_ROWS = 10_000


def page(df: DataFrame, order: Sequence[Key], number: int, size: int) -> DataFrame:
    """Rows of page ``number`` (from 1), each with the total of rows and pages.

    A deep page is cut out of a range-sorted table by the row counts of its partitions, so no task sorts all the
    pages before it. ``page_after`` is cheaper still for reading on.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    if number * size <= SHALLOW_ROWS:
        rows = df.orderBy(*sort_columns(order)).offset((number - 1) * size).limit(size)
    else:
        rows = _rows_between(df, order, (number - 1) * size, number * size)
    return rows.withColumns(
        {"total_records": total, "total_pages": F.ceil(total / F.lit(float(size))).cast("long"), "page": F.lit(number)}
    )


def _rows_between(df: DataFrame, order: Sequence[Key], start: int, end: int) -> DataFrame:
    ordered = range_sorted(df, order)
    counted = ordered.groupBy(F.shiftright(F.col(ROW_ID), PART_SHIFT).alias(PART)).agg(
        F.count(F.lit(1)).alias("size"), F.min(ROW_ID).alias("first")
    )
    wanted, at = F.lit(False), 0
    for part in counted.orderBy(PART).collect():
        low, high = max(start, at) - at, min(end, at + part["size"]) - at
        if low < high:
            wanted = wanted | F.col(ROW_ID).between(part["first"] + low, part["first"] + high - 1)
        at += part["size"]
    return ordered.filter(wanted).orderBy(ROW_ID).drop(ROW_ID)


def page_after(df: DataFrame, order: Sequence[Key], last_row: Mapping[str, Any], size: int) -> DataFrame:
    """The next ``size`` rows after ``last_row``. Its cost does not grow with the page number."""
    return df.filter(after(order, last_row, inclusive=False)).orderBy(*sort_columns(order)).limit(size)


def lookup(df: DataFrame, key: str, value: Any) -> DataFrame:
    """Rows of one key; the filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def lookup_many(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of all keys listed in ``keys``."""
    return df.join(keys.select(key).distinct(), key, "left_semi")
