"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes are the signs of rotated vectors; the rotations are learnt on a sample so that signs lose little. A shard of the index
files each code under every one of its substrings. Codes within Hamming distance r of a query agree with it up to
r // substrings bits in one substring at least, so looking up the substrings that near finds all of them. The
floats of the found are compared exactly. The radius grows until the k-th best cosine so far makes it unlikely that a
better vector's code lies outside: signs of rotated vectors differ with probability angle / pi.

All rows are in the index. Shards and batches of queries are of bounded size, and each pair of them is one group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.frames import stage
from souk.llm.vectors import answered, best, distinct_vectors, matrix, numbered, packed

#: Bits of a code, and of each of its substrings.
BITS = 256
SUBSTRING = 8
#: Rotations are learnt from about so many numbers (rows times dimensions) at most.
SAMPLE_NUMBERS = 1 << 20
ROUNDS = 15
#: First radius, and its growth while too few are found, in bits.
RADIUS, STEP = 31, 64
#: Standard deviations by which a better vector's code may differ more than expected.
MARGIN = 1.5
#: Bytes of vectors in a shard and in a batch of queries. Vectors are sent once per batch, queries once per shard, so that with
#: these sizes all vectors move once for every 16 MB of queries.
SHARD_BYTES = 4 << 20
BATCH_BYTES = 16 << 20
SEED = 42
VALUES = np.arange(1 << SUBSTRING, dtype=np.uint8)


def scaled(values: np.ndarray) -> np.ndarray | None:
    """The vector times a power of two, which changes no cosine and keeps squares in range; None for a zero vector."""
    largest = np.abs(values).max(initial=0.0)
    return np.ldexp(values, -int(np.frexp(largest)[1])) if largest > 0 else None


def learn_rotations(sample: np.ndarray, width: int) -> np.ndarray:
    """(width, BITS): rotations that turn the sample towards the corners of a cube (iterative quantization)."""
    draw, found, bits = np.random.default_rng(SEED), [], BITS
    while bits > 0:
        n = min(width, bits)
        rotation = np.linalg.qr(draw.normal(size=(width, width)))[0][:, :n]
        for _ in range(ROUNDS if len(sample) else 0):
            corners = np.where(sample @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(sample.T @ corners, full_matrices=False)
            rotation = u @ v
        found.append(rotation)
        bits -= n
    return np.concatenate(found, axis=1)


def codes(unit: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """(rows, BITS / 8) bytes: each byte is a substring."""
    return np.packbits(unit @ rotations > 0, axis=1)


class Shard:
    """A multi-index over some vectors: per substring, its values and the codes that have them."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], rotations: np.ndarray) -> None:
        self.vectors, self.ids, self.rotations = vectors, ids, rotations
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.codes = codes(vectors / self.norms[:, None], rotations)
        self.words = np.ascontiguousarray(self.codes).view(np.uint64)
        self.columns = np.ascontiguousarray(self.codes.T)
        self.filed = [np.argsort(column, kind="stable") for column in self.columns]
        self.starts = [
            np.searchsorted(column[order], range((1 << SUBSTRING) + 1))
            for column, order in zip(self.columns.astype(np.int64), self.filed, strict=True)
        ]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs in at most ``radius`` bits."""
        near = radius // len(code)
        hit = np.zeros(len(self.codes), bool)
        for byte, column, filed, starts in zip(code, self.columns, self.filed, self.starts, strict=True):
            probed = np.bitwise_count(VALUES ^ byte) <= near
            if near:  # many values: their lists are read off the column in one go
                hit |= probed[column]
            else:
                hit[filed[starts[byte] : starts[int(byte) + 1]]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(1) <= radius]

    def search(self, query: np.ndarray, k: int) -> list[tuple[int, float]]:
        """The k nearest (id, cosine) found."""
        norm = math.sqrt(float(query @ query))
        code = codes((query / norm)[None, :], self.rotations)[0]
        seen = np.zeros(len(self.vectors), bool)
        found: list[tuple[float, int]] = []
        radius = RADIUS
        while True:
            rows = self.within(code, min(radius, BITS))
            rows = rows[~seen[rows]]
            seen[rows] = True
            if len(rows):
                cosines = np.einsum("ij,j->i", self.vectors[rows], query) / (self.norms[rows] * norm)
                order = np.argsort(-cosines, kind="stable")
                last = cosines[order[min(k, len(order)) - 1]]  # ties with the k-th stay in
                found += [(-c, i) for c, r in zip(cosines, rows, strict=True) if c >= last for i in self.ids[r]]
                found = sorted(found)[:k]
            enough = math.ceil(expected_radius(-found[-1][0])) if len(found) == k else radius + STEP
            if radius >= min(enough, BITS):
                return [(i, -c) for c, i in found]
            radius = enough


def expected_radius(cosine: float) -> float:
    """Bits in which a vector that is at least this near to the query will hardly ever differ more."""
    p = math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    return BITS * p + MARGIN * math.sqrt(BITS * p * (1 - p))


def _search(rotations: np.ndarray, k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"q": [], "vec_id": [], "score": []}
        if queries.num_rows and rows.num_rows:
            width = len(rotations)
            shard = Shard(matrix(rows.column("vec"), width), rows.column("ids").to_pylist(), rotations)
            names = queries.column("q").to_pylist()
            for q, query in zip(names, matrix(queries.column("vec"), width), strict=True):
                for vec_id, score in shard.search(query, k):
                    out["q"].append(q)
                    out["vec_id"].append(vec_id)
                    out["score"].append(score)
        return pa.table(out, pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, by cosine in double precision.

    ``is_query`` is a condition on column ``id``. Ties go to the smaller vec_id; with fewer candidates all are returned.
    Rows without id and vectors that are null, zero or hold null or non-finite components take no part; missing
    last components count as zeros. Of rows that share an id one counts (that of the smallest packed vector). An
    empty table gives an empty result. Other columns are ignored.
    """
    # Each search is for one result more, since a query's own row is among them and leaves at the end.
    k_and_own = k + 1
    rows = stage(packed(vectors, id_col, vector_col, scaled))
    distinct = stage(distinct_vectors(rows, k_and_own))
    asked = numbered(rows.filter(is_query).select("vec").distinct(), "q")
    sizes = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vec")).alias("bytes")).first()
    width = max(1, (sizes["bytes"] or 0) // 8)
    few = max(1, SAMPLE_NUMBERS // width)
    part = min(1.0, few / max(1, sizes["n"]))
    drawn = distinct.filter(F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < F.lit(math.ceil(part * (1 << 20))))
    sample = matrix(pa.array([r["vec"] for r in drawn.select("vec").limit(2 * few).collect()], pa.binary()), width)
    norms = np.sqrt(np.einsum("ij,ij->i", sample, sample))
    rotations = learn_rotations(sample / norms[:, None], width)

    n_shards, n_batches = (
        max(1, -(-n * width * 8 // size)) for n, size in ((sizes["n"], SHARD_BYTES), (asked.count(), BATCH_BYTES))
    )
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = asked.withColumn("batch", F.pmod(F.xxhash64("q"), F.lit(n_batches))).withColumn("shard", all_of(n_shards))
    filed = distinct.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(n_shards))).withColumn("batch", all_of(n_batches))
    results = (
        queries.groupBy("batch", "shard")
        .cogroup(filed.groupBy("batch", "shard"))
        .applyInArrow(_search(rotations, k_and_own), "q long, vec_id long, score double")
    )
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return best(answered(results, asked, rows.filter(is_query), by_score, k_and_own), k, "double")
