"""Exact top-k search by integer inner product, pruned a block at a time.

A term is a component of the vectors. Vectors are put into ranges in which similar ones lie together, and each range
becomes a block with a forward index (its vectors) and the largest and smallest weight of every term. The sum over a
query's terms of the largest product possible in a block bounds all scores in it. Per query, blocks are scored in the
order of their bounds until the next bound is below the k-th best score so far.

Work is dealt out as (batch of queries, slot of blocks), both of bounded size. The blocks with the best bounds are scored
first; the k-th score among them decides which blocks are sent to a batch at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.frames import shuffle_width, stage
from souk.llm.vectors import answered, best, distinct_vectors, matrix, numbered, packed

SCALE = 1024
#: Distinct vectors in a block, blocks in a slot, queries in a batch.
BLOCK = 256
SLOT = 64
BATCH = 256
#: Blocks that are scored first for every query.
SEEDS = 3
#: Directions by whose signs vectors are put into ranges.
PLANES = 12
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)


def _bounds(queries: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """(queries, blocks): no score of a block is larger. Rounding is allowed for."""
    sums = np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ low.T
    room = np.abs(queries) @ np.maximum(np.abs(top), np.abs(low)).T
    return np.where(room < EXACT, sums, sums + room * 1e-9)


def inner_products(query: np.ndarray, block: np.ndarray) -> list[int] | np.ndarray:
    """Exact integer scores; those beyond 64 bits become the largest or smallest long."""
    if np.abs(block).max(initial=0) * np.abs(query).sum() < EXACT:
        return (block @ query).astype(np.int64)
    whole = [int(x) for x in query]
    sums = [sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in block]
    return np.array([min(max(s, LONG.min), LONG.max) for s in sums], dtype=np.int64)


class Best:
    """The k best (score, id) so far of a query."""

    def __init__(self, k: int, floor: float) -> None:
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def kth(self) -> float:
        return max(self.floor, float(self.scores[-1]) if len(self.scores) == self.k else -np.inf)

    def add(self, scores: np.ndarray, ids: list[list[int]]) -> None:
        chosen = np.flatnonzero(scores >= self.kth())
        flat = [(scores[i], x) for i in chosen for x in ids[i]]
        if not flat:
            return
        all_scores = np.concatenate([self.scores, np.array([s for s, _ in flat], np.int64)])
        all_ids = np.concatenate([self.ids, np.array([x for _, x in flat], np.int64)])
        order = np.lexsort((all_ids, ~all_scores))[: self.k]  # ~x falls as x grows, and cannot overflow
        self.scores, self.ids = all_scores[order], all_ids[order]


def _to_blocks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors: list[bytes] = []
        ids: list[list[int]] = []

        def out() -> pa.RecordBatch:
            m = matrix(pa.array(vectors, pa.binary()), width)
            top, low = m.max(0).tobytes(), m.min(0).tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids], pa.list_(pa.list_(pa.int64()))),
                    pa.array([m.tobytes()], pa.binary()),
                    pa.array([top], pa.binary()),
                    pa.array([low], pa.binary()),
                ],
                ["ids", "forward", "top", "low"],
            )

        for batch in batches:
            for v, i in zip(batch.column("vec").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                vectors.append(v)
                ids.append(i)
                if len(vectors) == BLOCK:
                    yield out()
                    vectors, ids = [], []
        if vectors:
            yield out()

    return run


def _signature(width: int):
    """Which side of some fixed planes a vector is on: near vectors are mostly on the same."""
    planes = np.random.default_rng(SCALE).normal(size=(width, PLANES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = matrix(batch.column("vec"), width) @ planes > 0
            code = pa.array(side @ (1 << np.arange(PLANES)), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, code], [*batch.schema.names, "code"])

    return run


def _seed(width: int):
    def run(key, queries: pa.Table, blocks: pa.Table) -> pa.Table:
        out = {"q": [], "batch": [], "block": [], "bound": []}
        if queries.num_rows and blocks.num_rows:
            bounds = _bounds(*(matrix(t.column(c), width) for t, c in ((queries, "vec"), (blocks, "top"), (blocks, "low"))))
            names = blocks.column("block").to_pylist()
            for q, row in zip(queries.column("q").to_pylist(), bounds, strict=True):
                for b in np.argsort(-row, kind="stable")[:SEEDS]:
                    for c, x in zip(out, (q, key[0].as_py(), names[b], float(row[b])), strict=True):
                        out[c].append(x)
        return pa.table(out, pa.schema([("q", pa.int64()), ("batch", pa.int64()), ("block", pa.int64()), ("bound", pa.float64())]))

    return run


def _survivors(width: int):
    def run(key, queries: pa.Table, blocks: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and blocks.num_rows:
            bounds = _bounds(*(matrix(t.column(c), width) for t, c in ((queries, "vec"), (blocks, "top"), (blocks, "low"))))
            floor = queries.column("floor").to_numpy()
            needed = (bounds >= floor[:, None]).any(0)
            found = [b for b, n in zip(blocks.column("block").to_pylist(), needed, strict=True) if n]
        return pa.table({"batch": pa.array([key[0].as_py()] * len(found), pa.int64()), "block": pa.array(found, pa.int64())})

    return run


def _search(width: int, k: int):
    """Score a batch of queries against blocks, each query in the order of its bounds."""

    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        out = {"q": [], "vec_id": [], "score": []}
        if queries.num_rows and blocks.num_rows:
            q_matrix = matrix(queries.column("vec"), width)
            forward = [np.frombuffer(f.as_py()).reshape(-1, width) for f in blocks.column("forward")]
            ids = blocks.column("ids").to_pylist()
            bounds = _bounds(q_matrix, matrix(blocks.column("top"), width), matrix(blocks.column("low"), width))
            floors = queries.column("floor").to_pylist()
            names = queries.column("q").to_pylist()
            for q, floor, vector, row in zip(names, floors, q_matrix, bounds, strict=True):
                found = Best(k, floor)
                for b in np.argsort(-row, kind="stable"):
                    if row[b] < found.kth():
                        break
                    found.add(inner_products(vector, forward[b]), ids[b])
                out["q"] += [q] * len(found.ids)
                out["vec_id"] += found.ids.tolist()
                out["score"] += found.scores.tolist()
        return pa.table(out, pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    return run


def quantised(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query with all other rows.

    Components become floor(1024 * x). ``is_query`` is a condition on column ``id``. Ties go to the smaller
    vec_id; with fewer candidates all are returned. Rows without id and vectors that are null or hold null or non-finite
    components take no part; empty vectors and missing last components count as zeros. Of rows that share
    an id one counts (that of the smallest packed vector). An empty table gives an empty result. Other columns are ignored.
    """
    # Each search is for one result more, since a query's own row is among them and leaves at the end.
    k_and_own = k + 1
    rows = stage(packed(vectors, id_col, vector_col, quantised))
    distinct = stage(distinct_vectors(rows, k_and_own))
    asked = numbered(rows.filter(is_query).select("vec").distinct(), "q")
    sizes = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vec")).alias("bytes")).first()
    width, n_blocks = max(1, (sizes["bytes"] or 0) // 8), -(-sizes["n"] // BLOCK) + shuffle_width(vectors)
    n_batches, n_slots = max(1, -(-asked.count() // BATCH)), max(1, -(-n_blocks // SLOT))

    ranged = (
        distinct.mapInArrow(_signature(width), "vec binary, ids array<long>, code long")
        .withColumn("first", F.col("ids")[0])
        .repartitionByRange(max(1, -(-sizes["n"] // (4 * BLOCK))), "code", "first")
        .sortWithinPartitions("code", "first")
        .mapInArrow(_to_blocks(width), "ids array<array<long>>, forward binary, top binary, low binary")
    )
    blocks = numbered(ranged, "block").withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(n_slots)))
    queries = stage(asked.withColumn("batch", F.pmod(F.xxhash64("q"), F.lit(n_batches))))
    every_slot = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slots - 1).cast("long")))
    every_batch = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_batches - 1).cast("long")))
    summaries = blocks.select("block", "top", "low", "slot").withColumn("batch", every_batch).groupBy("batch", "slot")

    # The blocks with the best bounds give a first k-th score.
    bounded = (
        queries.select("q", "vec", "batch")
        .withColumn("slot", every_slot)
        .groupBy("batch", "slot")
        .cogroup(summaries)
        .applyInArrow(_seed(width), "q long, batch long, block long, bound double")
    )
    order = Window.partitionBy("q").orderBy(F.desc("bound"), "block")
    seeds = stage(bounded.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= SEEDS).drop("r"))
    asking = queries.withColumn("floor", F.lit(float("-inf")))
    in_seeds = seeds.select("q", "block").join(asking, "q").groupBy("batch", "block")
    pairs = seeds.select(F.col("batch").alias("batch"), F.col("block").alias("block")).distinct()
    seed_blocks = pairs.join(blocks, "block").groupBy("batch", "block")
    scored = in_seeds.cogroup(seed_blocks).applyInArrow(_search(width, k_and_own), "q long, vec_id long, score long")
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    kth = scored.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") == k_and_own)
    floors = kth.select("q", F.col("score").cast("double").alias("floor"))
    with_floor = stage(
        queries.join(floors, "q", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    )

    # All blocks that can hold a better one are sent to the batch.
    needed = (
        with_floor.select("q", "vec", "batch", "floor")
        .withColumn("slot", every_slot)
        .groupBy("batch", "slot")
        .cogroup(summaries)
        .applyInArrow(_survivors(width), "batch long, block long")
    )
    sent = needed.join(blocks, "block").groupBy("batch", "slot")
    results = (
        with_floor.withColumn("slot", every_slot)
        .groupBy("batch", "slot")
        .cogroup(sent)
        .applyInArrow(_search(width, k_and_own), "q long, vec_id long, score long")
    )
    return best(answered(results, asked, rows.filter(is_query), by_score, k_and_own), k, "long")
