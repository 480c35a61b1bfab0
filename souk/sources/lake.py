"""Parquet layers and JSON sinks. Every write is done by the executors, partition by partition."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, TimestampNTZType, TimestampType

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


class EmptyWrite(RuntimeError):
    """A table was written but came back empty or incomplete."""


def read(spark: SparkSession, path: str, columns: Iterable[str] = ()) -> DataFrame:
    df = spark.read.parquet(path)
    names = list(columns)
    return df.select(*names) if names else df


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if the path does not exist. Any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> int:
    """Overwrite ``path`` with ``df`` and read it back; returns the number of rows.

    The row count is observed by the write job itself, so the plan runs once. AQE sizes the output files; no
    fixed file count is forced on the stages above.
    """
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    expected = written.get["rows"]
    verify(df.sparkSession, path, expected)
    return expected


def verify(spark: SparkSession, path: str, expected: int | None = None) -> int:
    found = spark.read.parquet(path).count()
    if found == 0 or (expected is not None and found != expected):
        raise EmptyWrite(f"{path}: {found} rows found, {expected} expected")
    return found


def delete(spark: SparkSession, folders: Iterable[str]) -> None:
    context = spark.sparkContext
    for folder in folders:
        place = context._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def _portable(value: Column, kind: DataType) -> Column:
    if isinstance(kind, TimestampType | TimestampNTZType):
        return F.date_format(value, ISO_FORMAT)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda item: _portable(item, kind.elementType))
    if isinstance(kind, StructType):
        fields = [_portable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def portable(df: DataFrame) -> DataFrame:
    """Timestamps, also those inside structs and arrays, as ISO text; the nesting stays."""
    return df.select(*(_portable(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))


def write_documents(df: DataFrame, path: str, mode: str = "overwrite", as_json: bool = True) -> None:
    """Write nested documents. ``append`` adds to a collection, ``overwrite`` replaces it."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    writer = portable(df).write.mode(mode)
    writer.option("ignoreNullFields", False).json(path) if as_json else writer.parquet(path)


def write_records(spark: SparkSession, records: list[Mapping], schema: str, path: str, mode: str = "append") -> None:
    """A few in-memory records, such as model metrics."""
    write_documents(spark.createDataFrame([Row(**r) for r in records], schema), path, mode)


def write_reports(reports: Mapping[str, DataFrame], root: str) -> None:
    """One JSON folder per report, and all of them together in ``all_reports``, one row per report row.

    The combined file is made from the written reports, so each report is computed once.
    """
    written = []
    for name, report in reports.items():
        path = f"{root}/{name}"
        write_documents(report, path)
        lines = report.sparkSession.read.text(path)
        written.append(lines.select(F.lit(name).alias("report"), F.col("value").alias("row")))
    if written:
        reduce(DataFrame.unionByName, written).write.mode("overwrite").json(f"{root}/all_reports")
