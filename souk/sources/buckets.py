"""Parquet tables in buckets of a key, so that joins and aggregates on the key need no exchange.

The rows of a bucket are dealt to ``SLICES`` writers by a hash of all columns, so a key with a third of all rows is not
written by one task, and each bucket has at most that many files, sorted by the key. A reader takes a bucket as one task:
give tables that are to be joined the same number of buckets, large enough for a bucket to suit a task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICES = 4
#: Folder with the schema alone, below the table's, which scans of the table pass over. An empty bucketed table has no file.
SCHEMA = "_schema"


def write(df: DataFrame, path: str, key: str, buckets: int, slices: int = SLICES) -> None:
    """Write ``df`` to ``path`` in buckets of ``key``, in place of what is there.

    A failed run can be repeated; until then there is nothing to read.
    """
    spark, table = df.sparkSession, _table()
    bucket = F.pmod(F.hash(_quoted(key)), F.lit(buckets))  # the function by which Spark assigns buckets
    by_hash = [F.col(_quoted(f.name)) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    slice_of = F.pmod(F.xxhash64(*by_hash), F.lit(slices))
    try:
        (
            df.repartition(bucket, slice_of)
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", path)
            .saveAsTable(table)
        )
        spark.createDataFrame([], df.schema).coalesce(1).write.parquet(f"{path}/{SCHEMA}")
    finally:
        spark.sql(f"drop table if exists {table}")  # forgets the name; the files of a table with a path stay


def read(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """The table that ``write`` left at ``path`` with the same key and number of buckets."""
    table = _table()
    fields = spark.read.parquet(f"{path}/{SCHEMA}").schema.fields
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table {table} ({columns}) using parquet clustered by ({_quoted(key)}) sorted by ({_quoted(key)}) "
        f"into {buckets} buckets location '{place}'"
    )
    try:
        return spark.read.table(table)
    finally:
        spark.sql(f"drop table {table}")


def _table() -> str:
    """A name of no meaning: the tables belong to their paths, not to a catalogue."""
    return f"bucketed_{uuid.uuid4().hex}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
