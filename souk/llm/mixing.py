"""Mixing sources to target weights by Poisson replication.

Each document is repeated as often as a Poisson variable with its source's repetition rate says. The variable is found by
inverting its distribution at a number hashed from the document's id (its text, if it has none) and a seed, so a rerun
gives the same mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.frames import fresh, shuffle_width, stage

#: Distributions of all sources with up to so many numbers together are broadcast (32 MB); beyond, documents are joined
#: with them in salted groups.
BROADCAST_NUMBERS = 1 << 22
#: A distribution is written out so many standard deviations, and as many steps more, on either side of its mean. What lies
#: outside is far below the hash's resolution.
DEVIATIONS, STEPS = 10, 30
SALTS = 64
HASH_BITS = 52


def uniform(*parts: Column | str) -> Column:
    """A whole number below 2**52 from a hash of the parts."""
    text = F.concat_ws(":", *(F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def poisson_cdf(rate: float) -> tuple[int, np.ndarray]:
    """The first k that can be drawn, and P(X <= k) from there on to where nothing is left."""
    if not rate > 0:
        return 0, np.ones(1)
    spread = DEVIATIONS * math.sqrt(rate) + STEPS
    first = max(0, math.floor(rate - spread))
    k = np.arange(first + 1, math.ceil(rate + spread) + 1, dtype=np.float64)
    # Each term is the one before times rate / k; logarithms are taken against the largest, so that none overflows.
    logs = np.concatenate([[0.0], np.cumsum(np.log(rate / k))])
    cdf = np.cumsum(np.exp(logs - logs.max()))
    return first, cdf / cdf[-1]


def _distributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            first, cdf = poisson_cdf(batch.column("rate")[i].as_py())
            columns = [batch.column("source").slice(i, 1), pa.array([first]), pa.array([cdf], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["source", "first", "cdf"])


def repetition_rates(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    weights: DataFrame | None = None,
    exponent: float = 0.5,
    epochs: float = 1.0,
) -> DataFrame:
    """(source, rate): how often each source's documents are to appear on average.

    The mix has ``epochs`` times the bytes of the corpus. A source's share of it is its weight in ``weights`` (source,
    weight; sources that are not in it get none), or without these its bytes to the power of ``exponent``. A null
    source is a source of its own. A source without any bytes keeps the rate ``epochs``.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("double")).alias("bytes")
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("bytes", F.lit(exponent)))
    else:
        given = weights.select(F.col("source").alias("name"), F.col("weight").cast("double").alias("weight"))
        given = given.groupBy("name").agg(F.sum("weight").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("name")), "left").select(
            "source", "bytes", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighed = stage(weighed)
    total = weighed.agg(F.sum("bytes").alias("bytes"), F.sum(F.when(F.col("bytes") > 0, F.col("weight"))).alias("w"))
    row = total.first()
    if not row["bytes"] or not row["w"]:
        return weighed.select("source", F.lit(float(epochs)).alias("rate"))
    share = F.col("weight") / F.lit(row["w"])
    rate = share * F.lit(float(epochs * row["bytes"])) / F.col("bytes")
    return weighed.select("source", F.when(F.col("bytes") > 0, rate).otherwise(F.lit(float(epochs))).alias("rate"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: DataFrame | None = None,
    exponent: float = 0.5,
    epochs: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """``docs`` with each row as often as its draw says, in random order, plus ``copy`` (from 1) and ``mix_key``.

    The order is that of ``mix_key`` within hashed partitions. Rows with one id get one draw, repeated rows too. Rows
    without id are hashed by their texts, so that only those with equal texts share a draw. Null and empty texts count no
    bytes. An empty table gives an empty result. Should
    ``docs`` have a column named like one that is added, underscores are put behind the added one's name.
    """
    copy, key = fresh(docs.columns, "copy"), fresh(docs.columns, "mix_key")
    rates = stage(repetition_rates(docs, source_col, text_col, weights, exponent, epochs))
    name, first, cdf, salt, n = (fresh(docs.columns, c) for c in ("_rated", "_first", "_cdf", "_salt", "_n"))
    kind = rates.schema["source"].dataType.simpleString()
    known = rates.mapInArrow(_distributions, f"source {kind}, first long, cdf array<double>").toDF(name, first, cdf)
    same = F.col(source_col).eqNullSafe(F.col(name))
    width = 2 * DEVIATIONS * F.sqrt(F.greatest("rate", F.lit(0.0))) + F.lit(2 * STEPS + 2)
    if (rates.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_NUMBERS:
        joined = docs.join(F.broadcast(known), same)
    else:
        salted = known.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = docs.withColumn(salt, F.pmod(F.xxhash64(id_col, text_col), F.lit(SALTS)).cast("int"))
        joined = own.join(salted, same & (own[salt] == salted[salt])).drop(salt)
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    id_text = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), digest))
    drawn = uniform(id_text, F.lit(str(seed))) / F.lit(float(1 << HASH_BITS))
    # The number of repetitions k with P(X <= k) not above the draw.
    repeated = (
        joined.withColumn(salt, drawn)
        .withColumn(n, (F.col(first) + F.size(F.filter(cdf, lambda c: c <= F.col(salt)))).cast("int"))
        .filter(F.col(n) > 0)
        .select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col(n))).alias(copy))
    )
    ordered = repeated.withColumn(key, uniform(id_text, F.col(copy).cast("string"), F.lit(str(seed))))
    return ordered.repartition(shuffle_width(docs), key, id_col, copy).sortWithinPartitions(key, id_col, copy)
