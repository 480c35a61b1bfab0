"""Documents of different shapes in one collection, each as a VARIANT under the kind it belongs to.

Nothing is padded: a document holds the fields of its kind, NULL ones included, and a new kind or field needs no new
column. Fields are read back by path and type, so a reader names only what it uses. The collection is stored by kind, so
one kind is read without the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.functions.measures import rows
from souk.operators.quality import FieldRule

KIND, DOCUMENT = "agg_type", "document"


def documents_of(df: DataFrame) -> DataFrame:
    """One VARIANT per row. Columns stand as fields of the same names; a decimal keeps its value, not its scale."""
    columns = [F.col(_quoted(name)) for name in df.columns]
    typed = [c.cast("string").alias(n) if k == "void" else c for c, (n, k) in zip(columns, df.dtypes, strict=True)]
    return df.select(F.to_variant_object(F.struct(*typed)).alias(DOCUMENT))


def as_columns(collection: DataFrame, parts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The documents of each kind as the columns that ``parts`` has for it."""
    return {kind: table_of(collection, kind, df.schema) for kind, df in parts.items()}


def collect_kinds(parts: Mapping[str, DataFrame]) -> DataFrame:
    """(agg_type, document) of all rows of all parts."""
    tagged = [documents_of(df).select(F.lit(kind).alias(KIND), DOCUMENT) for kind, df in parts.items()]
    return reduce(DataFrame.unionAll, tagged)


def write(collection: DataFrame, path: str) -> None:
    """Replace the kinds that ``collection`` holds and leave other kinds as they are."""
    (
        collection.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(KIND)
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{DOCUMENT} variant, {KIND} string").parquet(path).select(KIND, DOCUMENT)


def field(path: str, kind: str) -> Column:
    """The value at a dotted path of the document; NULL where there is none or it has another type."""
    return F.try_variant_get(DOCUMENT, _json_path(path), kind)


def table_of(collection: DataFrame, kind: str, schema: StructType) -> DataFrame:
    """The documents of one kind as columns."""
    columns = [field(f.name, f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return collection.filter(F.col(KIND) == kind).select(*columns)


def found_types(documents: DataFrame, paths: Sequence[str]) -> DataFrame:
    """(field, type, documents): how many documents hold a value of each type in each field, found document by document.

    The type is ``missing`` where a document lacks the field, ``VOID`` where it is null. Digits of decimals and contents
    of nested values are left out, so there are as many rows as fields and types, and the counting is map-side.
    """
    each = [F.struct(F.lit(p).alias("field"), _type_at(p).alias("type")) for p in paths]
    return documents.select(F.inline(F.array(*each))).groupBy("field", "type").agg(rows().alias("documents"))


def violations(documents: DataFrame, rules: Sequence[FieldRule], merged: bool = True) -> DataFrame:
    """(field, wrong_type, missing_required, documents, merged_type): how many documents break each rule, and the type all
    values of the field share (``VARIANT`` if none). It warns: nothing is dropped, and an empty collection breaks none.

    A document breaks a rule by a value whose own type is not allowed, and a required field also by having none or null.
    Without ``merged`` the last column is left out: Catalyst keeps an aggregate whose result goes unused here, and merging
    the types of every document costs more than the counts.
    """
    # Each field's type is found once a document; the counts would repeat it for each of their conditions.
    kinds = [_type_at(rule.path).alias(f"kind_{i}") for i, rule in enumerate(rules)]
    typed = documents.select(DOCUMENT, *kinds)
    checks = []
    for i, rule in enumerate(rules):
        kind = F.col(f"kind_{i}")
        absent = kind.isin("missing", "VOID")
        wrong = ~absent & ~kind.isin(*sorted({VARIANT_TYPES.get(t, t.upper()) for t in rule.types}))
        check = [
            F.lit(rule.path).alias("field"),
            F.count_if(wrong).alias("wrong_type"),
            F.count_if(absent & F.lit(rule.required)).alias("missing_required"),
        ]
        if merged:
            whole = F.schema_of_variant_agg(F.variant_get(DOCUMENT, _json_path(rule.path), "variant"))
            check.append(whole.alias("merged_type"))
        checks.append(F.struct(*check))
    counted = typed.agg(rows().alias("documents"), F.array(*checks).alias("checks"))
    last = ["merged_type"] if merged else []
    return counted.select(F.inline("checks"), "documents").select(
        "field", "wrong_type", "missing_required", "documents", *last
    )


#: What the type names of contracts are called inside documents, which have one width of whole numbers.
VARIANT_TYPES = {"int": "BIGINT", "bigint": "BIGINT", "struct": "OBJECT"}


def _type_at(path: str) -> Column:
    whole = F.schema_of_variant(F.variant_get(DOCUMENT, _json_path(path), "variant"))
    return F.coalesce(F.regexp_extract(whole, "^[A-Z_]+", 0), F.lit("missing"))


def _json_path(path: str) -> str:
    return "$" + "".join("['" + part + "']" for part in path.split("."))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
