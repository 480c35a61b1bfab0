"""Raw CSV: header row, UTF-8 with or without BOM, quoted newlines and doubled quotes."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from souk.functions.parsing import parsed as parsed_as
from souk.operators.staging import scope, stage
from souk.sources.contracts import CONTRACTS, FOLDERS, TableContract

SOURCE_FILE, INGESTED_AT, REJECTED, FILE_KEY = "_source_file", "_ingested_at", "_rejected", "_file_key"


def file_key() -> Column:
    """A name for the file that a row comes from, fit for a folder; never read as a number."""
    return F.concat(F.lit("f"), F.md5(F.col("_metadata.file_path")))


def headers(spark: SparkSession, path: str, only: Collection[str] | None = None) -> dict[str, tuple[str, ...]]:
    """The column names in the first line of each CSV file below ``path``, or of those in ``only``. A file without any
    text has none.

    One open and one line per file, as Spark itself does for Parquet footers.
    """
    context = spark.sparkContext
    java, conf = context._jvm.java.io, context._jsc.hadoopConfiguration()
    found = {}
    for row in spark.read.format("binaryFile").load(path).select("path").collect():
        if only is not None and row["path"] not in only:
            continue
        place = context._jvm.org.apache.hadoop.fs.Path(row["path"])
        reader = java.BufferedReader(java.InputStreamReader(place.getFileSystem(conf).open(place), "UTF-8"))
        try:
            line = (reader.readLine() or "").removeprefix("\ufeff")
        finally:
            reader.close()
        found[row["path"]] = tuple(c.strip() for c in next(csv.reader([line]), []))
    return {place: names for place, names in found.items() if names}


def parse(
    spark: SparkSession, path: str, free_text: bool = True, only: Collection[str] | None = None, keyed: bool = False
) -> DataFrame:
    """Every row of the CSV files below ``path``, each file read by its own header, all columns as text.

    A row with more or fewer fields than its header has stands in ``_rejected`` as it came; for all others that column
    is NULL. Columns that a file does not have are NULL. ``only`` names the files to read (all without it); ``keyed``
    adds the key of each row's file.

    Free text may hold newlines, which ``multiLine`` keeps inside their row at the price of one task per file. Only
    tables with free text pay it, and only once: they are landed as Parquet (``land``), which later reads split.
    """
    files: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for place, names in sorted(headers(spark, path, only).items()):
        files[names].append(place)
    parts, place_key = [], {FILE_KEY: file_key()} if keyed else {}
    for names, places in files.items():
        fields = [StructField(n, StringType()) for n in (*names, REJECTED)]
        parts.append(
            spark.read.schema(StructType(fields))
            .option("header", True)
            .option("multiLine", free_text)
            .option("escape", '"')
            .option("encoding", "UTF-8")
            .option("columnNameOfCorruptRecord", REJECTED)
            .option("columnPruning", False)  # else a row's length would only be seen if all columns are asked for
            .csv(places)
            # Spark refuses plans that read this column alone, so it also depends on another, in a way that is always true.
            .withColumn(REJECTED, F.when(F.coalesce(F.length(f"`{names[0]}`"), F.lit(0)) >= 0, F.col(REJECTED)))
            .withColumns({SOURCE_FILE: F.input_file_name(), **place_key})
        )
    if not parts:
        empty = spark.createDataFrame([], f"{REJECTED} string, {SOURCE_FILE} string")
        return empty.withColumns({c: F.lit("") for c in place_key})
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_text_columns(spark: SparkSession, path: str, free_text: bool = True) -> DataFrame:
    """The rows that fit their file's header, every column as text, named by that header."""
    return parse(spark, path, free_text).filter(F.col(REJECTED).isNull()).drop(REJECTED, SOURCE_FILE)


def rejected_rows(spark: SparkSession, path: str, free_text: bool = True) -> DataFrame:
    """(_source_file, record): the rows that do not, as they came."""
    bad = parse(spark, path, free_text).filter(F.col(REJECTED).isNotNull())
    return bad.select(SOURCE_FILE, F.col(REJECTED).alias("record"))


def apply_contract(raw: DataFrame, contract: TableContract) -> DataFrame:
    """Type the columns of a contract by name; a value that does not parse becomes NULL.

    A missing optional column is added as NULL, a missing required one is an error.
    """
    missing = contract.missing_columns(raw.columns)
    if missing:
        raise ValueError(f"{contract.name}: missing required columns {missing}")
    return raw.select(
        *(
            (parsed_as(F.col(f.name), f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in contract.schema.fields
        )
    )


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    contract = CONTRACTS[name]
    return apply_contract(read_text_columns(spark, path, contract.free_text), contract)


def table_paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{folder}" for name, folder in FOLDERS.items()}


def read_catalogue(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, name, path) for name, path in paths.items()}


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per raw file with its size in bytes and in megabytes."""
    meta = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("file_size"))
    return meta.withColumn("file_size_mb", F.round(F.col("file_size") / (1024 * 1024), 2))


def land(spark: SparkSession, name: str, path: str, bronze_root: str) -> str:
    """Copy one raw table into bronze as Parquet, text as it came, with its origin.

    Content is not judged here: a table that fails a quality check still lands, and the manifest says so. Rows that do
    not fit their file's header go to ``rejects_path``; landed and rejected rows together are all rows of the files.
    """
    target = table_paths(bronze_root)[name]
    with scope(spark):  # the files are parsed once
        parsed = stage(parse(spark, path, CONTRACTS[name].free_text))
        rows = parsed.filter(F.col(REJECTED).isNull()).drop(REJECTED)
        rows.withColumn(INGESTED_AT, F.current_timestamp()).write.mode("overwrite").parquet(target)
        bad = parsed.filter(F.col(REJECTED).isNotNull()).select(SOURCE_FILE, F.col(REJECTED).alias("record"))
        bad.write.mode("overwrite").parquet(rejects_path(name, bronze_root))
    return target


def rejects_path(name: str, bronze_root: str) -> str:
    return table_paths(f"{bronze_root.rstrip('/')}/rejected")[name]


def read_bronze(spark: SparkSession, name: str, bronze_root: str) -> DataFrame:
    return apply_contract(landed(spark, name, bronze_root), CONTRACTS[name])


def landed(spark: SparkSession, name: str, bronze_root: str, rejects: bool = False) -> DataFrame:
    """A landed table as text, or the rows set aside; without any row, a table with the contract's columns."""
    path = rejects_path(name, bronze_root) if rejects else table_paths(bronze_root)[name]
    try:
        return spark.read.option("mergeSchema", True).parquet(path)  # batches may have other columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    names = (SOURCE_FILE, "record") if rejects else (*CONTRACTS[name].schema.names, SOURCE_FILE)
    return spark.createDataFrame([], StructType([StructField(n, StringType()) for n in names]))


def exists(spark: SparkSession, path: str, fmt: str = "csv") -> bool:
    """Whether the path can be read at all; only "path not found" counts as absent."""
    try:
        spark.read.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
