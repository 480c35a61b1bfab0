"""Keeping the silver table up to date month by month instead of rewriting it.

The table is partitioned by purchase month. When rows of some orders come, change or go, only the months that hold these
orders, before or after, are built anew and replace their folders; all others keep their files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.dates import month_of
from souk.operators.staging import scope, shuffles_freed, stage
from souk.plans import silver
from souk.sources import lake
from souk.sources.tables import BY_ORDER, Tables

__all__ = ["BY_ORDER", "MONTH", "month_key", "orders_of_months", "read_by_month", "refresh", "touched_months", "write_by_month"]

#: Folder name of a month. The letter in front keeps Spark from reading it as a date.
MONTH = "_month"


def month_key(purchased: str = "order_purchase_timestamp") -> Column:
    return F.concat(F.lit("m"), month_of(F.col(purchased)))


def write_by_month(orders: DataFrame, path: str) -> int:
    """Write the whole silver table, one folder per purchase month; returns the number of rows."""
    with shuffles_freed(orders.sparkSession):
        return lake.write(orders.withColumn(MONTH, month_key()), path, (MONTH,))


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    return lake.read(spark, path).drop(MONTH)


def touched_months(spark: SparkSession, tables: Tables, path: str, order_ids: DataFrame) -> list[str]:
    """The months that hold any of the orders in the written table or in the raw orders. There are as many as months."""
    ids = order_ids.select("order_id").distinct()
    before = lake.read(spark, path).join(ids, "order_id", "left_semi").select(MONTH)
    after = tables.orders.join(ids, "order_id", "left_semi").select(month_key().alias(MONTH))
    both = before.unionByName(after).filter(F.col(MONTH).isNotNull()).distinct()
    return sorted(r[MONTH] for r in both.collect())


def orders_of_months(tables: Tables, months: list[str]) -> DataFrame:
    """Ids of the orders that have a raw row in one of the months."""
    return tables.orders.filter(month_key().isin(months)).select("order_id").distinct()


def refresh(spark: SparkSession, tables: Tables, path: str, order_ids: DataFrame) -> list[str]:
    """Bring the table at ``path`` up to date after rows of these orders have come, changed or gone; returns the months
    that were built anew. The result equals that of writing everything again.

    Folders are replaced by one job after the new rows have been written aside, and a run that fails can be repeated with
    the same ids.
    """
    with scope(spark), shuffles_freed(spark):
        ids = stage(order_ids.select("order_id").distinct())
        months = touched_months(spark, tables, path, ids)
        if not months:
            return []
        theirs = stage(orders_of_months(tables, months))
        built = silver.silver_orders(tables, lambda df: df.join(theirs, "order_id", "left_semi"), few=True)
        built = stage(built.withColumn(MONTH, month_key()).filter(F.col(MONTH).isin(months)))
        (
            built.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH)
            .parquet(path)
        )
        left = {r[MONTH] for r in built.select(MONTH).distinct().collect()}
        lake.delete(spark, (f"{path}/{MONTH}={m}" for m in months if m not in left))
        return months
