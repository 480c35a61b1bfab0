"""Links between texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Fingerprints of such texts differ in a dozen of 64 bits, too many to be filed under blocks of bits. The least hashes of
the shingle sets are filed instead, ``ROWS`` of them to a band: two texts with similarity s share one of ``BANDS`` bands with
probability 1 - (1 - s ** ROWS) ** BANDS, 0.9996 at 0.8. Every link is verified on the sets themselves.

Sets that share files, directly or through others, form a cluster, in which all pairs are looked at. So a set is sent to one
cluster, however many files it is in, and no pair is ever written: a task gets a cluster, or two chunks of a large one, counts
the shared shingles of all pairs in one matrix, and returns a spanning forest of the links. A cluster of n sets
costs about n / ``CHUNK`` copies of each of its sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.components import components
from souk.llm.frames import scope, shuffle_width, stage

SEED = 42
WORDS = 5
BANDS, ROWS = 20, 5
#: Sets in a chunk of a cluster, and their shingles, about; a set with more is a chunk of its own.
CHUNK = 1 << 10
CHUNK_SHINGLES = 1 << 19
#: Shingles in more sets of a task than this are counted by a matrix product, so many at a time; others pair by pair.
OFTEN = 24
COLUMNS = 1 << 11
#: Shingles whose signatures are computed at a time.
AT_ONCE = 1 << 11
_FACTORS = np.array([xxhash.xxh64_intdigest(f"factor {i}".encode(), SEED) | 1 for i in range(BANDS * ROWS)], np.uint64)
_TERMS = np.array([xxhash.xxh64_intdigest(f"term {i}".encode(), SEED) for i in range(BANDS * ROWS)], np.uint64)


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of lower-case words; one of the whole if it has fewer words."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    n = max(1, len(found) - words + 1)
    hashes = (xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), SEED) for i in range(n))
    return np.unique(np.fromiter(hashes, np.uint64, n))


def bands(hashes: np.ndarray) -> np.ndarray:
    """The keys under which a shingle set is filed; none for an empty set."""
    if not hashes.size:
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), AT_ONCE):
        least = np.minimum(least, (hashes[at : at + AT_ONCE, None] * _FACTORS + _TERMS).min(0))
    keys = [xxhash.xxh64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64)


def same_set(hashes: np.ndarray) -> int:
    """A digest of a shingle set, as a signed long."""
    return int(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), SEED)], np.uint64).view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_set(t.as_py()).view(np.int64) for t in batch.column("text")]
        columns = [batch.column("same"), batch.column("fp"), pa.array(found, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["same", "fp", "shingles"])


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    shingles = np.concatenate(sets) if m else np.zeros(0, np.int64)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    first = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1])) if len(shingles) else np.zeros(0, np.int64)
    counts = np.diff(first, append=len(shingles))
    column = np.repeat(np.arange(len(first)), counts)
    shared = np.zeros((m, m), np.float32)
    often = np.flatnonzero(counts > OFTEN)
    for at in range(0, len(often), COLUMNS):
        chosen = often[at : at + COLUMNS]
        place = np.full(len(first), -1)
        place[chosen] = np.arange(len(chosen))
        rows = np.flatnonzero(place[column] >= 0)
        held = np.zeros((m, len(chosen)), np.float32)
        held[owner[rows], place[column[rows]]] = 1
        shared += held @ held.T
    flat = shared.reshape(-1)
    rare = np.flatnonzero(counts[column] <= OFTEN) if len(first) else np.zeros(0, np.int64)
    for step in range(1, OFTEN):
        rare = rare[rare + step < len(column)]
        rare = rare[column[rare] == column[rare + step]]
        if not rare.size:
            break
        np.add.at(flat, owner[rare] * m + owner[rare + step], np.float32(1))
        np.add.at(flat, owner[rare + step] * m + owner[rare], np.float32(1))
    return shared.astype(np.int64)


def linked_in(sets: list[np.ndarray], part: np.ndarray, similarity: float) -> np.ndarray:
    """The least place that each set reaches through links of ``similarity`` or more.

    Sets of part 1 are compared with those of part 2 only, sets of part 0 with all.
    """
    sizes = np.array([len(s) for s in sets])
    shared = shared_counts(sets)
    either = np.maximum(sizes[:, None] + sizes[None, :] - shared, 1)
    linked = (shared / either >= similarity) & ((part == 0)[:, None] | (part[:, None] != part[None, :]))
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, prints, part, sets = None, [], [], []

        def out() -> pa.RecordBatch:
            label = linked_in(sets, np.array(part), similarity)
            moved = [i for i, x in enumerate(label.tolist()) if x != i]
            ends = [[prints[i] for i in moved], [prints[label[i]] for i in moved]]
            return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

        for batch in batches:
            shingles = batch.column("shingles")
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j")), strict=True)):
                if key != task:
                    if len(sets) > 1:
                        yield out()
                    task, prints, part, sets = key, [], [], []
                prints.append(batch.column("fp")[i].as_py())
                part.append(batch.column("part")[i].as_py())
                sets.append(shingles[i].values.to_numpy())
        if len(sets) > 1:
            yield out()

    return run


def _dealt(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """(root, i, j, part, fp, shingles): each set once for every pair of chunks of its cluster that it takes part in."""
    placed = sets.join(clusters, sets["same"] == clusters["node"])
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("shingles")).alias("held"))
    sizes = sizes.select("root", F.ceil(F.greatest(F.col("n") / CHUNK, F.col("held") / CHUNK_SHINGLES)).alias("chunks"))
    placed = placed.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("same", F.lit("chunk")), F.col("chunks")))
    # Chunk i meets chunk j >= i once: a set of chunk c goes to (c, j) for all j >= c and to (i, c) for i < c.
    place = lambda x: F.struct(
        F.least("own", x).alias("i"),
        F.greatest("own", x).alias("j"),
        F.when(x == F.col("own"), 0).when(x > F.col("own"), 1).otherwise(2).alias("part"),
    )
    chunks = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    return placed.withColumn("to", F.explode(F.transform(chunks, place))).select("root", "to.*", "fp", "shingles")


def similar_roots(prints: DataFrame, texts: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """(node, root) for every fingerprint that is linked, by ``links`` (a, b) or by similar shingle sets.

    ``prints`` has a row (version, fp, same, bands) per document, ``texts`` (version, text).
    """
    spark = prints.sparkSession
    with scope(spark, keep_last=True):
        firsts = stage(prints.groupBy("same").agg(F.min("fp").alias("fp"), F.min("version").alias("version")))
        equal = prints.select("same", F.col("fp").alias("b")).distinct().join(firsts, "same")
        links = links.unionByName(equal.select(F.col("fp").alias("a"), "b").filter("a <> b"))

        entries = stage(prints.select("same", F.explode("bands").alias("key")).distinct())
        files = entries.groupBy("key").agg(F.min("same").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        clusters = stage(components(entries.join(files, "key").select("same", "least").filter("same <> least")))
        chosen = firsts.join(clusters, firsts["same"] == clusters["node"], "left_semi")
        # Of the rows that hold a chosen text one is enough.
        own = texts.join(chosen, "version").dropDuplicates(["same"]).select("same", "fp", "text")
        sets = stage(own.mapInArrow(_sets, "same long, fp long, shingles array<long>"))
        dealt = _dealt(sets, clusters).repartition(shuffle_width(prints), "root", "i", "j")
        found = dealt.sortWithinPartitions("root", "i", "j").mapInArrow(_compare(similarity), "a long, b long")
        return stage(components(links.unionByName(found)))
