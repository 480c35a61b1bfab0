"""Documents of different shapes as VARIANT: written by kind, read back by path, checked one by one."""

import os

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_plans import plan
from test_upkeep import rows_of

from souk import catalog
from souk.operators.quality import NUMBER, OBJECT, TEXT, FieldRule
from souk.plans import collection


@pytest.fixture(scope="module")
def parts(spark):
    months = spark.sql("select '2020-01' m, cast(1.50 as decimal(12,2)) total, 3L n, null gap union all select '2020-02', null, 4L, null")
    places = spark.sql("select 'SP' m, named_struct('lat', 1.5D, 'lon', 2.5D) place, timestamp_ntz'2020-01-01 00:00:00' seen")
    return {"month": months, "place": places}


def test_round_trip_by_kind(spark, parts, tmp_path):
    path = str(tmp_path / "c")
    collection.write(collection.collect_kinds(parts), path)
    stored = collection.read(spark, path)
    months = collection.table_of(stored, "month", parts["month"].drop("gap").schema)
    assert months.schema["total"].dataType == parts["month"].schema["total"].dataType
    assert rows_of(months) == rows_of(parts["month"].drop("gap"))
    place = collection.table_of(stored, "place", parts["place"].schema).first()
    assert (place["place"]["lat"], place["seen"]) == (1.5, parts["place"].first()["seen"])
    assert "agg_type" in plan(months).split("PartitionFilters: [")[1].split("]")[0]


def test_writing_one_kind_leaves_the_others(spark, parts, tmp_path):
    path = str(tmp_path / "c")
    collection.write(collection.collect_kinds(parts), path)
    before = sorted(os.listdir(f"{path}/agg_type=place"))
    collection.write(collection.collect_kinds({"month": parts["month"].limit(1)}), path)
    counts = {r[0]: r[1] for r in collection.read(spark, path).groupBy("agg_type").count().collect()}
    assert counts == {"month": 1, "place": 1} and sorted(os.listdir(f"{path}/agg_type=place")) == before


def test_a_field_of_another_type_is_null(spark):
    docs = spark.sql("""select parse_json('{"a": "x", "b": {"c": 5}}') document""")
    row = docs.select(collection.field("a", "int"), collection.field("b.c", "int"), collection.field("b.d", "int")).first()
    assert tuple(row) == (None, 5, None)


RULES = (
    FieldRule("id", TEXT, required=True),
    FieldRule("amount", NUMBER),
    FieldRule("who", OBJECT),
    FieldRule("who.name", TEXT, required=True),
)


def found(docs):
    return {r["field"]: r.asDict() for r in collection.violations(docs, RULES).collect()}


def test_one_wrong_document_in_a_thousand(spark):
    text = F.when(F.col("id") % 1000 == 7, '{"id": "a", "amount": "n/a", "who": {"name": "x"}}').otherwise(
        '{"id": "a", "amount": 1.5, "who": {"name": "x"}}'
    )
    docs = spark.range(5000).select(F.parse_json(text).alias("document"))
    checks = found(docs)
    assert (checks["amount"]["wrong_type"], checks["amount"]["merged_type"]) == (5, "VARIANT")
    assert all(checks[f]["wrong_type"] == 0 for f in ("id", "who", "who.name"))
    types = {(r["field"], r["type"]): r["documents"] for r in collection.found_types(docs, ("amount", "who")).collect()}
    assert types == {("amount", "DECIMAL"): 4995, ("amount", "STRING"): 5, ("who", "OBJECT"): 5000}


def test_null_missing_and_scalar_documents(spark):
    texts = ['{"id": null}', "{}", "3", '{"id": 1, "who": "x"}', '{"id": "a", "who": {"name": "n"}, "amount": 7}', None]
    docs = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("document"))
    checks = found(docs)
    assert (checks["id"]["wrong_type"], checks["id"]["missing_required"]) == (1, 4)
    assert (checks["who"]["wrong_type"], checks["who"]["missing_required"]) == (1, 0)
    assert checks["who.name"]["missing_required"] == 5 and checks["amount"]["wrong_type"] == 0
    assert checks["id"]["documents"] == 6


def test_empty_collection_breaks_no_rule(spark):
    docs = spark.sql("select parse_json('1') document where false")
    assert all(c["wrong_type"] == c["missing_required"] == c["documents"] == 0 for c in found(docs).values())
    assert collection.found_types(docs, ("a",)).count() == 0


def test_counts_alone_merge_no_types(spark):
    """Each field's type is found once a document, and nothing is computed that goes unused."""
    docs = spark.range(50).select(F.parse_json(F.lit('{"id": 1, "who": {"name": "x"}}')).alias("document"))
    docs = docs.unionByName(spark.sql("select parse_json('{}') document"))
    counts = collection.violations(docs, RULES, merged=False)
    assert rows_of(counts) == rows_of(collection.violations(docs, RULES).drop("merged_type"))
    assert "schema_of_variant_agg" not in plan(counts)


def test_variants_of_the_catalog_merge_no_types(spark):
    text = plan(catalog.run("dq_contract_variants", spark, SF))
    assert "schema_of_variant_agg" not in text and "ObjectHashAggregate(keys=[]" not in text
