"""CSV reading, landing, the manifest, sinks, and the whole batch from raw files."""

import json

import pytest
from conftest import SF
from pyspark.sql import functions as F

from souk.operators import quality
from souk.plans import lakehouse
from souk.sources import lake, raw_csv, star
from souk.sources.contracts import CONTRACTS, TableContract
from souk.sources.tables import from_bronze


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path.parent)


def test_quoted_newlines_and_doubled_quotes(spark, tmp_path):
    folder = write(
        tmp_path / "reviews" / "a.csv",
        'review_id,order_id,review_score,review_comment_title,review_comment_message\n'
        'r1,o1,5,ok,"two\nlines, and ""quotes"""\nr2,o2,x,,\n',
    )
    rows = {r["review_id"]: r for r in raw_csv.read_table(spark, "reviews", folder).collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["review_comment_message"] == 'two\nlines, and "quotes"'
    assert rows["r2"]["review_score"] is None
    assert rows["r1"]["review_creation_date"] is None


def test_files_with_other_header_orders_and_misfit_rows(spark, tmp_path):
    """Each file is read by its own header; rows of another length are set aside as they came, and none is lost."""
    write(
        tmp_path / "sellers" / "a.csv",
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
        "s1,01000,sao paulo,SP\ns2,01000,sao, paulo,SP\ns3,01000\n",
    )
    folder = write(
        tmp_path / "sellers" / "b.csv",
        "seller_city,seller_state,seller_id,seller_zip_code_prefix\n\"ri\no\",RJ,s4,02000\n",
        "utf-8-sig",
    )
    write(tmp_path / "sellers" / "c.csv", "")
    whole = {r["seller_id"]: r.asDict() for r in raw_csv.read_text_columns(spark, folder).collect()}
    assert whole["s1"]["seller_state"] == "SP" and whole["s1"]["seller_city"] == "sao paulo"
    assert whole["s4"] == {
        "seller_id": "s4",
        "seller_zip_code_prefix": "02000",
        "seller_city": "ri\no",
        "seller_state": "RJ",
    }
    rejected = {r["record"]: r["_source_file"] for r in raw_csv.rejected_rows(spark, folder).collect()}
    assert set(rejected) == {"s2,01000,sao, paulo,SP", "s3,01000"}
    assert all(place.endswith("a.csv") for place in rejected.values())
    assert len(whole) + len(rejected) == 4
    assert raw_csv.read_text_columns(spark, folder).count() == raw_csv.rejected_rows(spark, folder).count() == 2

    bronze = str(tmp_path / "bronze")
    landed = spark.read.parquet(raw_csv.land(spark, "reviews", folder, bronze))
    set_aside = spark.read.parquet(raw_csv.rejects_path("reviews", bronze))
    assert landed.count() == 2 and set_aside.count() == 2
    contract = TableContract("sellers", "seller_id string", ("seller_id",), ("seller_id",))
    report = quality.table_report("sellers", landed, contract, set_aside).first()
    assert report["rejected_rows"] == 2 and not report["valid"] and "2 rows" in report["errors"][0]


def test_byte_order_mark_and_bad_timestamp(spark, tmp_path):
    folder = write(
        tmp_path / "t" / "a.csv", "product_category_name,product_category_name_english\ncasa,home\n", "utf-8-sig"
    )
    assert raw_csv.read_table(spark, "category_translation", folder).first()[0] == "casa"
    folder = write(
        tmp_path / "o" / "a.csv",
        "order_id,customer_id,order_status,order_purchase_timestamp\no1,c,x,2018-01-02 03:04:05\no2,c,x,soon\n",
    )
    orders = raw_csv.read_table(spark, "orders", folder).collect()
    found = {r["order_id"]: r["order_purchase_timestamp"] for r in orders}
    assert found["o1"].hour == 3 and found["o2"] is None


def test_leading_zeros_survive(spark, tmp_path):
    folder = write(tmp_path / "s" / "a.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,01234,a,b\n")
    assert raw_csv.read_table(spark, "sellers", folder).first()["seller_zip_code_prefix"] == "01234"


def test_missing_required_column(spark, tmp_path):
    folder = write(tmp_path / "s" / "a.csv", "seller_id,seller_city\ns,a\n")
    with pytest.raises(ValueError, match="seller_state"):
        raw_csv.read_table(spark, "sellers", folder)


def test_table_report(spark):
    contract = TableContract("t", "k string, v string", ("k", "v", "w"), ("k",))
    df = spark.createDataFrame([("a", "x"), ("a", " "), ("", None), (None, "y"), (" ", "z")], "k string, v string")
    found = quality.table_report("t", df, contract).first()
    assert found["null_counts"] == {"k": 3, "v": 2}
    assert found["duplicate_keys"] == 1
    assert found["missing_columns"] == ["w"]
    assert not found["valid"] and len(found["errors"]) == 2
    empty = quality.table_report("t", df.limit(0), contract).first()
    assert "table is empty" in empty["errors"]


def test_blank_text_and_null_keys_may_count_differently(spark):
    df = spark.createDataFrame([(None,), (None,), (" ",), ("a",)], "k string")
    strict = quality.null_profile(df, blank_is_null=True).first()
    plain = quality.null_profile(df).first()
    assert (strict["null_count"], plain["null_count"]) == (3, 2)
    assert quality.duplicate_keys(df, ["k"]).first()["duplicate_keys"] == 0
    assert quality.duplicate_keys(df, ["k"], null_keys_count=True).first()["duplicate_keys"] == 1


def test_contract_violations(spark):
    df = spark.sql("select 1 order_id, cast(null as string) order_status, named_struct('customer_id', 'c') customer")
    found = {r["field"]: r for r in quality.contract_violations(df, quality.DOCUMENT_RULES["orders"]).collect()}
    assert found["order_id"]["wrong_type"] == 1
    assert found["order_status"]["missing_required"] == 1
    assert found["customer.customer_id"]["wrong_type"] == 0
    assert found["items"]["wrong_type"] == 0


def test_write_reads_back(spark, tmp_path):
    assert lake.write(spark.range(10), str(tmp_path / "a")) == 10
    with pytest.raises(lake.EmptyWrite):
        lake.write(spark.range(0), str(tmp_path / "b"))
    with pytest.raises(lake.EmptyWrite):
        lake.verify(spark, str(tmp_path / "a"), 11)


def test_optional_table(spark, tmp_path):
    assert lake.read_optional(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        lake.read_optional(spark, str(tmp_path / "broken"))


def test_documents_overwrite_append_and_keep_nesting(spark, tmp_path):
    df = spark.sql("select 1 id, named_struct('at', timestamp'2018-01-02 03:04:05', 'x', cast(null as int)) part")
    path = str(tmp_path / "d")
    lake.write_documents(df, path)
    lake.write_documents(df, path)
    assert spark.read.json(path).count() == 1
    lake.write_documents(df, path, mode="append")
    assert spark.read.json(path).count() == 2
    line = json.loads(spark.read.text(path).first()[0])
    assert line["part"] == {"at": "2018-01-02T03:04:05", "x": None}
    with pytest.raises(ValueError):
        lake.write_documents(df, path, mode="ignore")


def test_records_and_reports(spark, tmp_path):
    lake.write_records(spark, [{"m": "a", "v": 1.5}], "m string, v double", str(tmp_path / "r"), "overwrite")
    assert spark.read.json(str(tmp_path / "r")).first()["v"] == 1.5
    lake.write_reports({"x": spark.range(2), "y": spark.range(3)}, str(tmp_path / "all"))
    combined = spark.read.json(str(tmp_path / "all" / "all_reports"))
    assert {r["report"]: r["count"] for r in combined.groupBy("report").count().collect()} == {"x": 2, "y": 3}


def test_source_files(spark, tmp_path):
    folder = write(tmp_path / "f" / "a.csv", "x\n" + "1\n" * 10)
    assert raw_csv.source_files(spark, folder).first()["file_size"] == 22


@pytest.fixture(scope="module")
def lakehouse_root(spark, tmp_path_factory):
    """Raw CSV files made from the star schema, with one table missing and one duplicated order."""
    root = tmp_path_factory.mktemp("lake")
    paths = raw_csv.table_paths(str(root / "raw"))
    tables = dict(star.from_star(spark, SF).items())
    tables["orders"] = tables["orders"].unionByName(tables["orders"].filter("order_id = 1"))
    for name, df in tables.items():
        text = [
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if "timestamp" in t else F.col(c) for c, t in df.dtypes
        ]
        df.select(*text).write.option("header", True).option("escape", '"').csv(paths[name])
    return lakehouse.run(spark, paths, str(root / "lake"))


def test_manifest(spark, lakehouse_root):
    found = {r["table_name"]: r for r in spark.read.json(lakehouse_root.at("manifest")).collect()}
    assert found["geolocation"]["errors"] == ["source not found"]
    assert found["orders"]["duplicate_keys"] == 1 and not found["orders"]["valid"]
    assert found["customers"]["valid"]
    assert set(found) == set(CONTRACTS)


def test_bronze_has_origin(spark, lakehouse_root):
    landed = spark.read.parquet(raw_csv.table_paths(lakehouse_root.bronze)["orders"])
    assert landed.filter(F.col("_source_file").endswith(".csv") & F.col("_ingested_at").isNotNull()).count() > 0


def test_batch_agrees_with_direct_plan(spark, shop, lakehouse_root):
    """From CSV the ids are text and freight has two digits, so compare what does not depend on either."""
    batch = lake.read(spark, lakehouse_root.silver_orders)
    assert len(batch.columns) == 59
    assert batch.count() == shop.orders.count()

    def statuses(df):
        return {tuple(r) for r in df.groupBy("order_status", "delivery_status").count().collect()}

    assert statuses(batch) == statuses(shop.orders)
    assert from_bronze(spark, lakehouse_root.bronze).orders.schema == CONTRACTS["orders"].schema


def test_batch_writes_gold_documents_and_reports(spark, lakehouse_root):
    customers = lake.read(spark, lakehouse_root.gold("rfm_customers")).count()
    assert lake.read(spark, lakehouse_root.gold("customer_segments")).count() == customers
    assert lake.read(spark, lakehouse_root.gold("churn_predictions")).count() == customers
    documents = spark.read.json(lakehouse_root.documents("customers"))
    assert documents.count() == customers
    assert documents.filter("segment_name = 'Unknown'").count() == 0
    assert spark.read.json(lakehouse_root.at("reports", "orders_by_status")).count() == 3
    summaries = spark.read.json(lakehouse_root.documents("aggregations"))
    kinds = {r[0] for r in summaries.select("agg_type").distinct().collect()}
    assert kinds >= {"segment_stats", "monthly_revenue", "model_performance"}
