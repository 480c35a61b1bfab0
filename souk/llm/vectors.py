"""What the two vector searches share: reading vectors, merging equal ones, packing and unpacking rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.frames import stage


def packed(
    df: DataFrame, id_col: str, vector_col: str, prepare: Callable[[np.ndarray], np.ndarray | None]
) -> DataFrame:
    """(id, vec): vectors as packed doubles after ``prepare``, which drops a vector by returning None. One row per id:
    of several, that of the smallest packed vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = [], []
            for id_, vector in zip(*(batch.column(c).to_pylist() for c in ("id", "vec")), strict=True):
                if id_ is None or vector is None or None in vector:
                    continue
                values = np.array(vector, dtype=np.float64)
                if np.isfinite(values).all() and (values := prepare(values)) is not None:
                    ids.append(id_)
                    vectors.append(values.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())], ["id", "vec"])

    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
    return own.mapInArrow(run, "id long, vec binary").groupBy("id").agg(F.min("vec").alias("vec"))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(vec, ids): each distinct vector with its ``most`` smallest ids. Equal vectors score alike and ties go to the
    smaller id, so a list of fewer results never needs another id of the same vector."""
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("r", rank).filter(F.col("r") <= most)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Packed vectors as rows of ``width`` doubles; shorter ones end in zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        values = np.frombuffer(v.as_py())
        out[i, : len(values)] = values
    return out


def numbered(df: DataFrame, name: str) -> DataFrame:
    """A staged copy with a number for every row."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()))


def answered(results: DataFrame, asked: DataFrame, rows: DataFrame, order, most: int) -> DataFrame:
    """(query_id, vec_id, score): the ``most`` first results of each distinct query for all ``rows`` that ask it, without
    the asking row itself."""
    few = results.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most).drop("r")
    asking = rows.join(asked.select("q", "vec"), "vec").select("q", F.col("id").alias("query_id"))
    return asking.join(few, "q").filter("query_id <> vec_id").drop("q")


def best(rows: DataFrame, k: int, kind: str) -> DataFrame:
    """The k best (query_id, vec_id, score) rows of each query, ranked; ties go to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        rows.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", F.col("score").cast(kind))
    )
