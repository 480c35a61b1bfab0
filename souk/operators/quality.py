"""Data quality: profiles, keys, verdicts, the ingestion manifest and document contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.measures import percent, rows, rows_where
from souk.functions.text import is_blank
from souk.operators.inference import broken_counts
from souk.sources.contracts import TableContract


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(rows().alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
            )
            for name, df in tables.items()
        ]
    )


def _missing(column: str, blank_is_null: bool) -> Column:
    c = F.col(column)
    return is_blank(c) if blank_is_null else c.isNull()


def null_profile(df: DataFrame, columns: Sequence[str] = (), blank_is_null: bool = False) -> DataFrame:
    """NULLs (or NULLs and blanks) of every column from one pass; one row per column."""
    names = list(columns) or df.columns
    counts = [
        F.struct(F.lit(c).alias("column_name"), rows_where(_missing(c, blank_is_null)).alias("null_count"))
        for c in names
    ]
    return (
        df.agg(rows().alias("row_count"), F.array(*counts).alias("counts"))
        .select("row_count", F.inline("counts"))
        .select("column_name", "null_count", percent("null_count", "row_count").alias("null_pct"))
    )


def null_counts(tables: Mapping[str, tuple[DataFrame, TableContract]]) -> DataFrame:
    """NULL or blank required columns of every table."""
    return _union(
        [
            null_profile(df, contract.required, blank_is_null=True).select(
                F.lit(name).alias("table_name"), "column_name", "null_count"
            )
            for name, (df, contract) in tables.items()
        ]
    )


def _has_key(key: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in key])


def _duplicates(key: Sequence[str], null_keys_count: bool) -> Column:
    if null_keys_count:
        return rows() - F.count_distinct(F.struct(*(F.col(c) for c in key)))
    present = _has_key(key)
    return rows_where(present) - F.count_distinct(F.when(present, F.struct(*(F.col(c) for c in key))))


def duplicate_keys(df: DataFrame, key: Sequence[str], null_keys_count: bool = False) -> DataFrame:
    """Rows with a key minus distinct keys. ``null_keys_count`` treats NULL as a key value like any other."""
    return df.agg(
        (rows() if null_keys_count else rows_where(_has_key(key))).alias("key_count"),
        _duplicates(key, null_keys_count).alias("duplicate_keys"),
    )


def table_report(
    name: str, df: DataFrame, contract: TableContract, rejected: DataFrame | None = None
) -> DataFrame:
    """One manifest row for a table; ``rejected`` holds the raw rows that could not be read.

    Null counts collapse to one row per task; the distinct keys, which cannot, are counted in a subquery that reads
    the key alone.
    """
    missing = contract.missing_columns(df.columns)
    present = [c for c in contract.required if c in df.columns]
    has_key = contract.key and not set(contract.key) - set(df.columns)
    facts = df.agg(
        rows().alias("row_count"),
        F.map_from_entries(
            F.array(*(F.struct(F.lit(c), rows_where(_missing(c, True))) for c in present))
        ).alias("null_counts"),
        broken_counts(df, contract).alias("broken_counts"),
    )
    no_duplicates = F.lit(0).cast("long")
    duplicates = df.agg(_duplicates(contract.key, False)).scalar() if has_key else no_duplicates
    lost = rejected.agg(rows()).scalar() if rejected is not None else F.lit(0).cast("long")
    facts = facts.withColumns({"duplicate_keys": duplicates, "rejected_rows": lost})
    broken = F.aggregate(F.map_values("broken_counts"), F.lit(0).cast("long"), lambda acc, n: acc + n)
    errors = [
        F.lit(f"missing required columns: {', '.join(missing)}" if missing else None),
        F.when(F.col("row_count") == 0, "table is empty"),
        F.when(
            F.col("rejected_rows") > 0,
            F.concat(F.col("rejected_rows").cast("string"), F.lit(" rows do not fit their header")),
        ),
        F.when(broken > 0, F.concat(broken.cast("string"), F.lit(" values do not parse"))),
        F.when(
            F.col("duplicate_keys") > 0,
            F.concat(F.col("duplicate_keys").cast("string"), F.lit(f" duplicate values in {', '.join(contract.key)}")),
        ),
    ]
    return facts.select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(missing).cast("array<string>").alias("missing_columns"),
        F.map_filter("null_counts", lambda _, n: n > 0).alias("null_counts"),
        F.map_filter("broken_counts", lambda _, n: n > 0).alias("broken_counts"),
        "duplicate_keys",
        "rejected_rows",
        F.array_compact(F.array(*(e.cast("string") for e in errors))).alias("errors"),
    ).withColumn("valid", F.size("errors") == 0)


def absent_report(spark: SparkSession, name: str) -> DataFrame:
    """The manifest row of a table whose source is not there; only such tables are not landed."""
    return spark.range(1).select(
        F.lit(name).alias("table_name"),
        F.lit(0).cast("long").alias("row_count"),
        F.lit(0).alias("column_count"),
        F.array().cast("array<string>").alias("missing_columns"),
        F.create_map().cast("map<string,bigint>").alias("null_counts"),
        F.create_map().cast("map<string,bigint>").alias("broken_counts"),
        F.lit(0).cast("long").alias("duplicate_keys"),
        F.lit(0).cast("long").alias("rejected_rows"),
        F.array(F.lit("source not found")).alias("errors"),
        F.lit(False).alias("valid"),
    )


def manifest(tables: Mapping[str, tuple[DataFrame, TableContract]]) -> DataFrame:
    return _union([table_report(name, df, contract) for name, (df, contract) in tables.items()])


def manifest_summary(reports: DataFrame) -> DataFrame:
    nulls = F.aggregate(F.map_values("null_counts"), F.lit(0).cast("long"), lambda acc, n: acc + n)
    return reports.agg(
        rows().alias("total_files"),
        rows_where(F.col("valid")).alias("valid_files"),
        F.sum("row_count").alias("total_rows"),
        F.sum(nulls).alias("total_nulls"),
    ).withColumn("null_pct", percent("total_nulls", "total_rows"))


def rows_removed(raw: DataFrame, deduplicated: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows before, after removing duplicates and after all filters."""

    def step(name: str, df: DataFrame) -> DataFrame:
        return df.agg(rows().alias("row_count")).select(F.lit(name).alias("step"), "row_count")

    steps = _union([step("raw", raw), step("deduplicated", deduplicated), step("cleaned", cleaned)])
    names = ("raw", "deduplicated", "cleaned")
    counts = [F.max(F.when(F.col("step") == s, F.col("row_count"))).alias(s) for s in names]
    return steps.agg(*counts).select(
        F.col("raw").alias("raw_rows"),
        (F.col("raw") - F.col("deduplicated")).alias("removed_as_duplicates"),
        (F.col("raw") - F.col("cleaned")).alias("removed_in_total"),
        F.col("cleaned").alias("remaining_rows"),
    )


@dataclass(frozen=True)
class FieldRule:
    """A document field (dotted for nested ones) with its allowed Spark types."""

    path: str
    types: tuple[str, ...]
    required: bool = False


TEXT = ("string",)
NUMBER = ("double", "float", "decimal", "int", "bigint")
OBJECT = ("struct",)

# The document contracts.
DOCUMENT_RULES = {
    "orders": (
        FieldRule("order_id", TEXT, required=True),
        FieldRule("order_status", TEXT, required=True),
        FieldRule("customer", OBJECT),
        FieldRule("customer.customer_id", TEXT),
        FieldRule("customer.customer_unique_id", TEXT),
        FieldRule("customer.customer_city", TEXT),
        FieldRule("customer.customer_state", TEXT),
        FieldRule("items", OBJECT),
        FieldRule("payment", OBJECT),
        FieldRule("review", OBJECT),
        FieldRule("order_value", NUMBER),
        FieldRule("delivery_days", NUMBER),
    ),
    "customers": (
        FieldRule("customer_unique_id", TEXT, required=True),
        FieldRule("customer_state", TEXT),
        FieldRule("customer_city", TEXT),
        FieldRule("recency", NUMBER),
        FieldRule("frequency", NUMBER),
        FieldRule("monetary", NUMBER),
        FieldRule("segment_name", TEXT),
        FieldRule("churn_prediction", NUMBER),
        FieldRule("churn_probability", NUMBER),
    ),
    "products": (
        FieldRule("product_id", TEXT, required=True),
        FieldRule("category_en", TEXT),
        FieldRule("total_orders", NUMBER),
        FieldRule("total_revenue", NUMBER),
        FieldRule("avg_price", NUMBER),
        FieldRule("avg_review_score", NUMBER),
    ),
    "sellers": (
        FieldRule("seller_id", TEXT, required=True),
        FieldRule("seller_city", TEXT),
        FieldRule("seller_state", TEXT),
        FieldRule("total_items_sold", NUMBER),
        FieldRule("total_revenue", NUMBER),
    ),
}


def _type_at(df: DataFrame, path: str) -> str | None:
    kind = df.schema
    for name in path.split("."):
        if name not in getattr(kind, "names", ()):
            return None
        kind = kind[name].dataType
    return kind.typeName() if kind.typeName() == "struct" else kind.simpleString().split("(")[0]


def contract_violations(df: DataFrame, rules: Sequence[FieldRule]) -> DataFrame:
    """How many documents break each rule. It warns: nothing is dropped.

    A field of the wrong type is broken by each document that has a value there; a required field also by each
    document that has none.
    """
    checks = []
    for rule in rules:
        kind = _type_at(df, rule.path)
        value = F.col(rule.path) if kind else F.lit(None)
        wrong = rows_where(value.isNotNull()) if kind and kind not in rule.types else F.lit(0).cast("long")
        absent = rows_where(value.isNull()) if rule.required else F.lit(0).cast("long")
        checks.append(
            F.struct(F.lit(rule.path).alias("field"), wrong.alias("wrong_type"), absent.alias("missing_required"))
        )
    return df.agg(rows().alias("documents"), F.array(*checks).alias("checks")).select(
        F.inline("checks"), "documents"
    )


def group_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value. The total is a scalar subquery, as a column may have any number of values."""
    groups = df.groupBy(column).agg(rows().alias("row_count"))
    return groups.withColumn("percentage", percent("row_count", df.agg(rows()).scalar()))
