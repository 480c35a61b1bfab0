"""Connected components of a link table by alternating star steps.

Each step is a grouped minimum and a join, so no node's links are gathered in one task, and each step's links are
written to the shared folder, so a lost executor costs one step. Large-star/small-star (Kiveris et al., 2014) needs
a number of steps that grows with the logarithm of the size of a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.frames import scope, stage


def _least(links: DataFrame) -> DataFrame:
    """(u, least): the least of u and its partners in ``links``."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger partner of a node moves to the least partner of that node."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = both.filter("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller partner of a node, and the node itself, move to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).filter("u <> v").distinct()


def _fingerprint(links: DataFrame) -> tuple:
    """Order-free digest of a link table (wraps around instead of overflowing)."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s"),
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node of its component.

    ``links`` has two columns of one orderable type; direction, repeats and self-links do not matter.
    An empty table gives an empty result.
    """
    a, b = links.columns
    spark, seen = links.sparkSession, None
    now = stage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct())
    with scope(spark, keep_last=True):
        while True:
            now = stage(_small_star(_large_star(now)))
            digest = _fingerprint(now)
            if digest == seen or digest[0] == 0:
                break
            seen = digest
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
