"""Schema inference over text columns: the narrowest type that holds every value, and how many values break a contract.

Each value has a kind, a bit; a column's kinds are the OR of its values' bits, which adds up in any order and across
files, tasks and batches. The type is read off the bits: whole numbers widen to long, decimal and double; numbers mixed
with timestamps, or anything else, are text; a column of blanks has no type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from souk.functions.dates import TIMESTAMP_FORMAT
from souk.functions.measures import percent, rows, rows_where
from souk.functions.parsing import breaks
from souk.functions.text import is_blank
from souk.sources.contracts import TableContract

INT, LONG, DECIMAL, DOUBLE, TIMESTAMP, TEXT = (1 << i for i in range(6))
MOST_DIGITS = 38
WHOLE = r"^[+-]?[0-9]+$"
FRACTION = r"^[+-]?[0-9]*[.][0-9]+$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2})?$"


def _value(c: Column) -> Column:
    return F.trim(c)


def _whole_digits(value: Column) -> Column:
    """Digits before the point, leading zeros aside."""
    return F.length(F.regexp_replace(value, r"^[+-]?0*|[.].*$", ""))


def _scale(value: Column) -> Column:
    return F.length(F.regexp_extract(value, r"[.]([0-9]+)$", 1))


def kind(c: Column) -> Column:
    """The bit of a text value; 0 for NULL and blanks."""
    v = _value(c)
    fits = _whole_digits(v) + _scale(v) <= MOST_DIGITS
    whole = F.when(v.try_cast("int").isNotNull(), INT).when(v.try_cast("bigint").isNotNull(), LONG)
    is_moment = F.coalesce(
        F.try_to_timestamp(v, F.lit(TIMESTAMP_FORMAT)), F.try_to_timestamp(v, F.lit(TIMESTAMP_FORMAT.split()[0]))
    ).isNotNull()
    return (
        F.when(is_blank(c), 0)
        .when(v.rlike(WHOLE), whole.when(fits, DECIMAL).otherwise(DOUBLE))
        .when(v.rlike(FRACTION), F.when(fits, DECIMAL).otherwise(DOUBLE))
        .when(v.rlike(NUMBER), DOUBLE)
        .when(v.rlike(MOMENT) & is_moment, TIMESTAMP)
        .otherwise(TEXT)
    )


def joined_type(kinds: Column, whole_digits: Column, scale: Column) -> Column:
    """The name of the narrowest type for a column's bits, most digits before and behind the point."""
    has = lambda bits: kinds.bitwiseAND(bits) > 0
    numbers = INT | LONG | DECIMAL | DOUBLE
    precision = F.greatest(whole_digits + scale, F.lit(1))
    decimal = F.when(precision > MOST_DIGITS, "double").otherwise(F.format_string("decimal(%d,%d)", precision, scale))
    return (
        F.when(has(TEXT) | (has(TIMESTAMP) & has(numbers)), "string")
        .when(has(TIMESTAMP), "timestamp")
        .when(has(DOUBLE), "double")
        .when(has(DECIMAL), decimal)
        .when(has(LONG), "bigint")
        .when(has(INT), "int")
        .otherwise("void")
    )


def _facts(df: DataFrame, contract: TableContract) -> Column:
    """One struct of mergeable facts per text column."""
    declared = {f.name: f.dataType for f in contract.schema.fields}
    columns = []
    for name in df.columns:
        c, target = F.col(f"`{name}`"), declared.get(name, StringType())
        v, k = _value(c), kind(c)
        exact = k.bitwiseAND(INT | LONG | DECIMAL) > 0
        columns.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(target.simpleString() if name in declared else None).cast("string").alias("contract_type"),
                F.coalesce(F.bit_or(k), F.lit(0)).alias("kinds"),
                F.coalesce(F.max(F.when(exact, _whole_digits(v))), F.lit(0)).alias("whole_digits"),
                F.coalesce(F.max(F.when(exact, _scale(v))), F.lit(0)).alias("scale"),
                rows_where(is_blank(c)).alias("null_count"),
                rows_where(breaks(c, target)).alias("broken_values"),
            )
        )
    return F.array(*columns)


def inferred_table(name: str, df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per column of a table of text: inferred and contract type, blanks, and values that the contract would
    turn into NULL. All columns are looked at in one pass, and each task hands on one row."""
    facts = df.agg(rows().alias("row_count"), _facts(df, contract).alias("facts"))
    return facts.select("row_count", F.inline("facts")).select(
        F.lit(name).alias("table_name"),
        "column_name",
        joined_type(F.col("kinds"), F.col("whole_digits"), F.col("scale")).alias("inferred_type"),
        "contract_type",
        "row_count",
        percent("null_count", "row_count").alias("null_pct"),
        "broken_values",
    )


def inferred_schema(tables: Mapping[str, tuple[DataFrame, TableContract]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [inferred_table(name, df, c) for name, (df, c) in tables.items()])


def broken_counts(df: DataFrame, contract: TableContract) -> Column:
    """A map from each contract column that is still text to its values that do not parse, none of them zero."""
    raw = {c for c, kind in df.dtypes if kind == "string"}
    typed = [f for f in contract.schema.fields if f.name in raw and not isinstance(f.dataType, StringType)]
    counts = [F.struct(F.lit(f.name), rows_where(breaks(F.col(f"`{f.name}`"), f.dataType))) for f in typed]
    pairs = F.array(*counts) if counts else F.array().cast("array<struct<a:string,b:bigint>>")
    return F.map_from_entries(pairs)


def as_text(df: DataFrame, names: Sequence[str] = ()) -> DataFrame:
    """A typed table as raw files would have it: all columns as text, moments in the format of the contracts."""
    kinds = dict(df.dtypes)
    return df.select(
        *(
            (F.date_format(c, TIMESTAMP_FORMAT) if "timestamp" in kinds[c] else F.col(c).cast("string")).alias(c)
            for c in (names or df.columns)
        )
    )
