"""The eight tables the analyses run on."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from souk.sources import raw_csv


#: Tables whose rows belong to one order.
BY_ORDER = ("orders", "order_items", "payments", "reviews")


@dataclass(frozen=True)
class Tables:
    orders: DataFrame
    order_items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    category_translation: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


def from_bronze(spark: SparkSession, bronze_root: str) -> Tables:
    return Tables(**{f.name: raw_csv.read_bronze(spark, f.name, bronze_root) for f in fields(Tables)})


def from_csv(spark: SparkSession, raw_root: str) -> Tables:
    paths = raw_csv.table_paths(raw_root)
    return Tables(**{f.name: raw_csv.read_table(spark, f.name, paths[f.name]) for f in fields(Tables)})
