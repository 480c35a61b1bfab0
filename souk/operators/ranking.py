"""Exact ranks over a whole table without a single-task window.

``ntile`` and exact percentiles need global row positions, and a window without PARTITION BY sends every row to one
task. Here the rows are range-sorted and staged, each partition is counted, and only the few rows at the wanted
positions are looked up. What reaches the driver is one count per partition and those few rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from souk.operators.ordering import Key, after, asc, sort_columns
from souk.operators.staging import stage

ROW_ID, GROUP, PART, POSITION, OFFSET = "_row_id", "_group", "_part", "_position", "_offset"
# monotonically_increasing_id keeps the partition number above its lowest 33 bits.
PART_SHIFT = 33


def range_sorted(df: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """A staged copy of ``df`` in global order; ``_row_id`` grows with that order."""
    return stage(df.sort(*sort_columns(keys)).withColumn(ROW_ID, F.monotonically_increasing_id()))


def rows_at(
    ordered: DataFrame,
    positions: Callable[[int], Iterable[int]],
    group: str | None = None,
    weight: str | None = None,
) -> list[Row]:
    """The rows at the given 0-based positions of a ``range_sorted`` table.

    ``positions`` maps the number of rows of a group to the wanted positions in it. With ``weight``, a row stands
    for that many equal rows. Only partitions that hold a wanted row are read a second time.
    """
    of_group = F.col(group).cast("string") if group else F.lit("")
    located = ordered.withColumns(
        {
            GROUP: of_group,
            PART: F.shiftright(F.col(ROW_ID), PART_SHIFT),
            "_weight": (F.col(weight) if weight else F.lit(1)).cast("long"),
        }
    )
    counted = located.groupBy(GROUP, PART).agg(F.sum("_weight").alias("size"), F.min(ROW_ID).alias("first_id"))
    parts: dict[str | None, list[Row]] = defaultdict(list)
    for row in counted.orderBy(PART).collect():
        parts[row[GROUP]].append(row)

    wanted = []
    for name, of_name in parts.items():
        targets = sorted(set(positions(sum(p["size"] for p in of_name))))
        start = 0
        for p in of_name:
            wanted += [(name, p[PART], t, t - start, p["first_id"]) for t in targets if 0 <= t - start < p["size"]]
            start += p["size"]
    if not wanted:
        return []
    hits = _by_weight(located, wanted) if weight else _by_id(located, wanted)
    return hits.drop(ROW_ID, PART, "_weight").collect()


def _by_id(located: DataFrame, wanted: Sequence[tuple]) -> DataFrame:
    """Unweighted: the position fixes the row id. The id filter reaches the Parquet scan."""
    places = {first_id + offset: position for _, _, position, offset, first_id in wanted}
    position = F.coalesce(*(F.when(F.col(ROW_ID) == i, F.lit(p)) for i, p in sorted(places.items())))
    return located.filter(F.col(ROW_ID).isin(sorted(places))).withColumn(POSITION, position.cast("long"))


def _by_weight(located: DataFrame, wanted: Sequence[tuple]) -> DataFrame:
    """Weighted: running totals inside the partitions concerned, joined to the short list of positions."""
    spark = located.sparkSession
    spec = f"{GROUP} string, {PART} long, {POSITION} long, {OFFSET} long"
    lookup = F.broadcast(spark.createDataFrame([w[:4] for w in wanted], spec))
    in_part = Window.partitionBy(GROUP, PART).orderBy(ROW_ID).rowsBetween(Window.unboundedPreceding, 0)
    return (
        located.filter(F.col(PART).isin(sorted({w[1] for w in wanted})))
        .withColumn("_upto", F.sum("_weight").over(in_part))
        .join(lookup, [GROUP, PART])
        .filter((F.col(OFFSET) < F.col("_upto")) & (F.col(OFFSET) >= F.col("_upto") - F.col("_weight")))
        .drop(OFFSET, "_upto")
    )


def ntile_starts(rows: int, buckets: int) -> list[int]:
    """First position of each bucket but the first: sizes differ by at most one, larger buckets first."""
    small, larger = divmod(rows, buckets)
    return [b * small + min(b, larger) for b in range(1, min(buckets, rows))]


def distributed_ntile(df: DataFrame, buckets: int, keys: Sequence[Key]) -> Column:
    """``ntile(buckets) OVER (ORDER BY keys)`` as a column over ``df``, equal to the window row by row.

    The keys must order the rows totally. Sorts the key columns of ``df`` now; the returned column compares each
    row with the first row of every bucket, so using it adds no shuffle.
    """
    ordered = range_sorted(df.select(*(k.column for k in keys)), keys)
    firsts = rows_at(ordered, lambda n: ntile_starts(n, buckets))
    bucket = F.lit(1)
    for row in firsts:
        bucket = bucket + after(keys, row.asDict(), inclusive=True).cast("int")
    return bucket


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float]
) -> dict[str, dict[float, float | None]]:
    """Interpolated percentiles of several numeric columns, NULLs left out.

    Equal values are merged before the sort, so a value held by most rows costs one row.
    """

    def around(n: int) -> list[int]:
        exact = [(n - 1) * p for p in points]
        return [i for x in exact for i in (math.floor(x), math.ceil(x))]

    values = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).unpivot(
        [], list(columns), "measure", "value"
    )
    counted = values.filter(F.col("value").isNotNull()).groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    ordered = range_sorted(counted, [asc("measure"), asc("value")])
    totals = {r["measure"]: r["n"] for r in ordered.groupBy("measure").agg(F.sum("n").alias("n")).collect()}
    found = {(r["measure"], r[POSITION]): r["value"] for r in rows_at(ordered, around, "measure", "n")}

    def at(column: str, point: float) -> float | None:
        if column not in totals:
            return None
        x = (totals[column] - 1) * point
        low, high = found[column, math.floor(x)], found[column, math.ceil(x)]
        return low + (high - low) * (x - math.floor(x))

    return {c: {p: at(c, p) for p in points} for c in columns}
