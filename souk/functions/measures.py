"""Aggregate expressions shared by the reports.

Money is summed as DECIMAL, so a sum does not depend on the order in which partitions are merged, and becomes
DOUBLE only at the edge of a report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """A DECIMAL amount as a DOUBLE with two digits."""
    return F.round(col(c), 2).cast("double")


def total(c: str | Column) -> Column:
    return money(F.sum(col(c)))


def mean(c: str | Column) -> Column:
    """Mean of integers or decimals; the sum under it is exact. NULL when there is nothing to average."""
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)).cast("double"))


def mean_of_ratios(c: str | Column) -> Column:
    """Mean of a DOUBLE column such as a score or a ratio, each value taken to ten digits.

    A sum of doubles changes in its last bits with the merge order; a sum of decimals does not, so this mean is the
    same on every run and every cluster.
    """
    return mean(col(c).cast("decimal(38,10)"))


def rows() -> Column:
    return F.count(F.lit(1))


def rows_where(condition: Column) -> Column:
    return F.count_if(condition)


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """``part`` in percent of ``whole``; 0 when ``whole`` is 0."""
    part, whole = col(part).cast("double"), col(whole).cast("double")
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)) * 100, digits)


def with_share(groups: DataFrame, count: str, name: str = "percentage") -> DataFrame:
    """Add each group's share of all rows.

    ``groups`` is already aggregated to one row per status, state, month or the like, so the unpartitioned window
    sees a handful of rows, and the fact table is read once instead of twice.
    """
    return groups.withColumn(name, percent(count, F.sum(count).over(Window.partitionBy())))


def rounded_or_zero(c: str | Column, digits: int = 2) -> Column:
    return F.round(F.coalesce(col(c).cast("double"), F.lit(0.0)), digits)
