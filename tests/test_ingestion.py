"""Inferred schemas, values that do not parse, and landing only new or changed files."""

import os
import time

import pytest
from pyspark.sql import functions as F
from test_sources import write

from souk.operators import inference, quality
from souk.plans import lakehouse
from souk.sources import ledger, raw_csv
from souk.sources.contracts import CONTRACTS, TableContract

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


@pytest.mark.parametrize(
    ("values", "wanted"),
    [
        ([None, "", "  "], "void"),
        (["1", " 2 ", None, "-003"], "int"),
        (["1", "3000000000"], "bigint"),
        (["1", "9" * 19], "decimal(19,0)"),
        (["1", "9" * 39], "double"),
        (["12.50", "1", "-.125"], "decimal(5,3)"),
        (["1.5", "2e3"], "double"),
        (["9" * 30 + "." + "1" * 9], "double"),
        (["9" * 30, "0." + "1" * 9], "double"),
        (["2018-01-02 03:04:05", "2018-01-02"], "timestamp"),
        (["2018-02-31"], "string"),
        (["2018-01-02", "7"], "string"),
        (["1", "x"], "string"),
        (["NaN", "1"], "string"),
        ([], "void"),
    ],
)
def test_narrowest_type(spark, values, wanted):
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(3)
    found = inference.inferred_table("t", df, TableContract("t", "c string", ("c",))).first()
    assert found["inferred_type"] == wanted and found["row_count"] == len(values)


def test_inference_looks_once_and_combines_by_task(spark):
    df = spark.range(100).selectExpr("cast(id as string) a", "concat('x', id) b", "cast(id / 8 as string) c")
    plan = inference.inferred_table("t", df, CONTRACTS["sellers"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 100") == 1 and plan.count("Exchange") == 1


def test_values_that_break_the_contract_are_counted(spark, tmp_path):
    folder = write(
        tmp_path / "raw" / "a.csv",
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p,s,2018-01-02 03:04:05,12.50,1\no2,one,p,s,soon,free,2\no3,,p,s,,3,x\n",
    )
    contract = CONTRACTS["order_items"]
    raw = raw_csv.read_text_columns(spark, folder)
    found = {r["column_name"]: r for r in inference.inferred_table("order_items", raw, contract).collect()}
    broken = {c: r["broken_values"] for c, r in found.items() if r["broken_values"]}
    assert broken == {"order_item_id": 1, "shipping_limit_date": 1, "price": 1, "freight_value": 1}
    assert found["order_item_id"]["inferred_type"] == "string" and found["order_item_id"]["contract_type"] == "int"
    assert found["order_id"]["null_pct"] == 0 and found["order_item_id"]["null_pct"] == 33.33
    report = quality.table_report("order_items", raw, contract).first()
    assert report["broken_counts"] == broken and "4 values do not parse" in report["errors"] and not report["valid"]


def rows_of(spark, bronze, rejects=False):
    df = raw_csv.landed(spark, "sellers", bronze, rejects)
    return sorted(r[0 if not rejects else "record"] for r in df.select("record" if rejects else "seller_id").collect())


def land(spark, folder, bronze):
    done = ledger.land_changed(spark, "sellers", folder, bronze)
    return done.parsed, done.removed, done.untouched


def files_below(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def later(path):
    """The clock of a file system may be coarse."""
    os.utime(path, (time.time() + 60, time.time() + 60))


def test_only_new_and_changed_files_are_parsed(spark, tmp_path, monkeypatch):
    bronze = str(tmp_path / "bronze")
    folder = write(tmp_path / "raw" / "a.csv", HEADER + "s1,1,a,SP\ns2,2\n")
    write(tmp_path / "raw" / "b.csv", HEADER + "s3,3,a,RJ\n")
    assert land(spark, folder, bronze) == (2, 0, 0)
    assert rows_of(spark, bronze) == ["s1", "s3"] and rows_of(spark, bronze, True) == ["s2,2"]
    first = files_below(bronze)

    def refuse(*args, **kwargs):
        raise AssertionError("an old file was parsed")

    with monkeypatch.context() as patch:
        patch.setattr(raw_csv, "parse", refuse)
        assert land(spark, folder, bronze) == (0, 0, 2)
    assert files_below(bronze) == first

    parsed = []
    honest = raw_csv.parse
    with monkeypatch.context() as patch:
        patch.setattr(raw_csv, "parse", lambda *a, **k: parsed.append(sorted(k["only"])) or honest(*a, **k))
        write(tmp_path / "raw" / "a.csv", "seller_id,seller_state,seller_city,seller_zip_code_prefix,extra\ns4,SP,a,1,x\n")
        later(tmp_path / "raw" / "a.csv")
        write(tmp_path / "raw" / "c d.csv", HEADER + "s5,5,c,MG\n")
        assert land(spark, folder, bronze) == (2, 0, 1)
    assert [os.path.basename(p) for p in parsed[0]] == ["a.csv", "c d.csv"]
    assert rows_of(spark, bronze) == ["s3", "s4", "s5"] and rows_of(spark, bronze, True) == []
    of_b = {f for f in first if "rejected" not in f and "ledger" not in f} & files_below(bronze)
    assert len(of_b) == 1  # the rows of b.csv are the files written first

    os.remove(tmp_path / "raw" / "b.csv")
    assert land(spark, folder, bronze) == (0, 1, 2) and rows_of(spark, bronze) == ["s4", "s5"]
    typed = {r["seller_id"]: r for r in raw_csv.read_bronze(spark, "sellers", bronze).collect()}
    assert typed["s4"]["seller_state"] == "SP" and typed["s5"]["seller_zip_code_prefix"] == "5"


def test_a_failed_run_is_repeated_safely(spark, tmp_path, monkeypatch):
    bronze = str(tmp_path / "bronze")
    folder = write(tmp_path / "raw" / "a.csv", HEADER + "s1,1,a,SP\n")
    land(spark, folder, bronze)
    write(tmp_path / "raw" / "a.csv", HEADER + "s1,1,a,RJ\ns2,2,b,SP\n")
    later(tmp_path / "raw" / "a.csv")

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "_entries", fail)
        with pytest.raises(RuntimeError):
            land(spark, folder, bronze)
    assert land(spark, folder, bronze) == (1, 0, 0) and rows_of(spark, bronze) == ["s1", "s2"]
    anew = str(tmp_path / "anew")
    raw_csv.land(spark, "sellers", folder, anew)
    whole = raw_csv.read_bronze(spark, "sellers", anew)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, raw_csv.read_bronze(spark, "sellers", bronze).collect()))


def test_a_table_landed_whole_before_is_replaced(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    folder = write(tmp_path / "raw" / "a.csv", HEADER + "s1,1,a,SP\n")
    raw_csv.land(spark, "sellers", folder, bronze)
    assert land(spark, folder, bronze) == (1, 0, 0) and rows_of(spark, bronze) == ["s1"]


def test_files_without_rows(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    folder = write(tmp_path / "raw" / "a.csv", "")  # Spark lists no file of no bytes
    assert land(spark, folder, bronze) == (0, 0, 0) and rows_of(spark, bronze) == [] == rows_of(spark, bronze, True)
    write(tmp_path / "raw" / "a.csv", HEADER)
    assert land(spark, folder, bronze) == (1, 0, 0) and rows_of(spark, bronze) == []
    assert land(spark, folder, bronze) == (0, 0, 1)
    write(tmp_path / "raw" / "a.csv", HEADER + "s1,1,a,SP\n")
    later(tmp_path / "raw" / "a.csv")
    assert land(spark, folder, bronze) == (1, 0, 0) and rows_of(spark, bronze) == ["s1"]


def test_ledger_tells_what_was_landed(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    folder = write(tmp_path / "raw" / "a.csv", HEADER + "s1,1,a,SP\ns2,2\n")
    write(tmp_path / "raw" / "b.csv", HEADER + "s2,2\ns1,1,a,SP\n")
    land(spark, folder, bronze)
    book = {os.path.basename(r["path"]): r for r in spark.read.parquet(ledger.ledger_path("sellers", bronze)).collect()}
    assert [book["a.csv"][c] for c in ("row_count", "rejected_rows", "size")] == [1, 1, len(HEADER) + 15]
    assert book["a.csv"]["content_hash"] == book["b.csv"]["content_hash"]


def test_manifest_of_a_second_run_is_the_same(spark, tmp_path):
    folder = write(tmp_path / "raw" / "a.csv", HEADER + "s1,1,a,SP\ns2,2\n")
    layout = lakehouse.Layout(str(tmp_path / "lake"))
    first = [r.asDict() for r in lakehouse.ingest(spark, {"sellers": folder}, layout).collect()]
    again = [r.asDict() for r in lakehouse.ingest(spark, {"sellers": folder}, layout).collect()]
    assert first == again and first[0]["row_count"] == 1 and first[0]["rejected_rows"] == 1
    assert first[0]["column_count"] == 4
    assert spark.read.parquet(ledger.ledger_path("sellers", layout.bronze)).filter(F.col("row_count") == 1).count() == 1
