"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators.staging import scope, stage

__all__ = ["batches_by_bytes", "fresh", "keyed", "scope", "shuffle_width", "stage"]


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name that differs from all of ``columns``, also if case is ignored."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``id`` (long) and ``text`` (null becomes empty), whatever else the table holds."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def batches_by_bytes(
    batches: Iterable[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of ``column`` each (one row at least)."""
    for batch in batches:
        sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)]
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
