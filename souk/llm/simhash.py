"""SimHash near-duplicates through tables of distances to reference fingerprints.

Equal fingerprints are merged first, so a thousand copies of a text cost one row. Two fingerprints that differ in at
most ``max_distance`` bits agree on at least ``BLOCKS - max_distance`` of the ``BLOCKS`` bit blocks, hence each
fingerprint is filed once per choice of that many blocks. Within a file, a table holds the Hamming distance of every
fingerprint to the reference fingerprints: by the triangle inequality two fingerprints whose distances to one
reference differ by more than ``max_distance`` cannot be linked. Only the pairs that survive all references are
compared bit by bit. A file with many members is dealt out as pairs of chunks, so that no task holds more than two
chunks, and a task returns a spanning forest of the links it found, not all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import similar
from souk.llm.components import components
from souk.llm.frames import fresh, keyed, scope, shuffle_width, stage

SEED = 42
BITS = 64
BLOCKS = 6
REFERENCES = 24
#: Members of one file that a task compares with each other or with as many others.
CHUNK = 2048
#: Shingle hashes whose bits are counted at a time.
AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """The 64-bit SimHash of a text; 0 if it has no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle_words + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first = (ends - lengths)[:n].tolist()
    last = ends[len(words) - n :].tolist()
    counts, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, AT_ONCE):
        pieces = zip(first[at : at + AT_ONCE], last[at : at + AT_ONCE], strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in pieces], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">u8")[0])


def version_of(text: Column) -> Column:
    """A hash that tells apart the texts of rows that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(
    docs: DataFrame, id_col: str, text_col: str, shingle_words: int = 3, with_bands: bool = False
) -> DataFrame:
    """(id, version, fp): one row per row of ``docs``; version is a hash of the text, fp the fingerprint as a signed
    long. With ``with_bands`` also ``same`` and ``bands``, the digest and the file keys of the set of five-word shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle_words) for t in batch.column("text")]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            columns = [batch.column("id"), batch.column("version"), pa.array(signed)]
            if with_bands:
                sets = [similar.shingle_set(t.as_py()) for t in batch.column("text")]
                columns.append(pa.array([similar.same_set(s) for s in sets], pa.int64()))
                columns.append(pa.array([similar.bands(s) for s in sets], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = {"id": "long", "version": "long", "fp": "long"}
    kinds |= {"same": "long", "bands": "array<long>"} if with_bands else {}
    names = list(kinds)
    texts = keyed(docs, id_col, text_col).withColumn("version", version_of(F.col("text")))
    return texts.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in kinds.items()))


def _blocks() -> list[int]:
    """Bit masks of the blocks, of nearly equal width."""
    edges = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def references(count: int = REFERENCES) -> np.ndarray:
    """The reference fingerprints: the block masks, then words drawn from the hash of their number."""
    drawn = [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(max(0, count - BLOCKS))]
    return np.array((_blocks() + drawn)[:count], dtype=np.uint64)


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member that each of n members reaches through the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_in_groups(
    group: np.ndarray, part: np.ndarray, prints: np.ndarray, refs: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal ``group`` (equal ones adjacent), as (member, least member reached).

    ``part`` keeps apart the two chunks of a pair: rows of one chunk (part 1 or 2) are not compared with each other,
    rows with part 0 are compared with all of their group.
    """
    n = len(prints)
    table = np.bitwise_count(prints[:, None] ^ refs[None, :]).astype(np.int8)
    left, right, held = [], [], 0
    label = np.arange(n)
    at, step = np.arange(n - 1), 1
    while at.size:
        at = at[at + step < n]
        at = at[group[at] == group[at + step]]
        pairs = at[(part[at] == 0) | (part[at] != part[at + step])]
        for c in range(table.shape[1]):
            if not pairs.size:
                break
            pairs = pairs[np.abs(table[pairs, c] - table[pairs + step, c]) <= radius]
        pairs = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + step]) <= radius]
        if pairs.size:
            left.append(pairs)
            right.append(pairs + step)
            held += pairs.size
        if held > 1 << 20:  # what was found so far shrinks to a forest
            label = _forest(n, np.concatenate([*left, np.arange(n)]), np.concatenate([*right, label]))
            left, right, held = [], [], 0
        step += 1
    label = _forest(n, np.concatenate([*left, np.arange(n)]), np.concatenate([*right, label]))
    moved = np.flatnonzero(label != np.arange(n))
    return prints[moved], prints[label[moved]]


def _compare(radius: int):
    refs = references()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []  # rows of the group that may go on in the next batch

        def out(rows: np.ndarray) -> pa.RecordBatch:
            a, b = links_in_groups(rows[0], rows[1], rows[2].view(np.uint64), refs, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            rows = np.stack([columns["file"], columns["part"].astype(np.int64), columns["fp"]])
            rows = np.concatenate([*kept, rows], axis=1)
            cut = np.searchsorted(rows[0], rows[0][-1])  # files arrive in order
            kept = [rows[:, cut:]]
            if cut:
                yield out(rows[:, :cut])
        if kept:
            yield out(kept[0])

    return run


def links(distinct: DataFrame, max_distance: int = 3) -> DataFrame:
    """(a, b): links between the fingerprints in column ``fp`` of ``distinct``, enough to join all that belong
    together (a spanning forest of each file, by tasks)."""
    if not 0 <= max_distance < BLOCKS:
        raise ValueError(f"max_distance must be below {BLOCKS}")
    masks = _blocks()
    choices = [sum(masks[i] for i in chosen) for chosen in combinations(range(BLOCKS), BLOCKS - max_distance)]
    entries = F.array(
        *(
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bits"))
            for i, m in enumerate(choices)
        )
    )
    filed = distinct.select("fp", F.explode(entries).alias("e")).select("fp", "e.choice", "e.bits")
    sizes = filed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = filed.join(sizes, ["choice", "bits"]).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("long"))
    # Chunk i of a file meets chunk j >= i once: rows of chunk c go to (c, j) for all j >= c and to (i, c) for i < c.
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks"))
    place = lambda x: F.struct(
        F.least(F.col("own"), x).alias("i"),
        F.greatest(F.col("own"), x).alias("j"),
        F.when(x == F.col("own"), 0).when(x > F.col("own"), 1).otherwise(2).alias("part"),
    )
    dealt = (
        members.withColumn("own", own)
        .withColumn("to", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), place)))
        .select(
            F.xxhash64("choice", "bits", "to.i", "to.j").alias("file"),
            F.col("to.part").cast("int").alias("part"),
            "fp",
        )
    )
    # Two files under one 64-bit key would only be compared in vain: every link is verified.
    sorted_files = dealt.repartition(shuffle_width(distinct), "file").sortWithinPartitions("file", "part", "fp")
    return sorted_files.mapInArrow(_compare(max_distance), "a long, b long")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_distance: int, similarity: float | None
) -> DataFrame:
    """(fp, id, version, root, group): every row of ``docs`` with its group's least fingerprint and least id."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words, with_bands=similarity is not None))
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    distinct = stage(distinct)
    found = links(distinct, max_distance)
    if similarity is None:
        roots = components(found)
    else:
        texts = keyed(docs, id_col, text_col).select(version_of(F.col("text")).alias("version"), "text")
        roots = similar.similar_roots(prints, texts, found, similarity)
    roots = roots.withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Most fingerprints stand alone; only the others need their group's least id looked up.
    least = rooted.groupBy("root").agg(F.min("least").alias("group"))
    named = prints.select("fp", "id", "version")
    return named.join(rooted.join(least, "root").select("fp", "root", "group"), "fp")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_distance: int = 3,
    similarity: float | None = 0.8,
) -> DataFrame:
    """(id, fp, group): every row of ``docs`` with its fingerprint and the smallest id it is linked to, directly or
    through others.

    Texts are linked if their fingerprints differ in ``max_distance`` bits or fewer, and if their sets of five-word shingles
    have a Jaccard similarity of ``similarity`` or more (see ``similar``; None leaves these links out).
    Null texts count as empty. Texts without words have fingerprint zero and are linked like all others; texts with
    fewer words than a shingle have one shingle. Repeated rows stay, with the same group. A null id is passed
    on and is never the smallest, unless a group has nothing else (then the group is null). An empty table gives an
    empty result. Other columns are ignored.
    """
    return _grouped(docs, id_col, text_col, shingle_words, max_distance, similarity).select("id", "fp", "group")


def first_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_distance: int = 3,
    similarity: float | None = 0.8,
) -> DataFrame:
    """``docs`` with one row for each group of near-duplicates: that of the smallest id.

    A group without any id keeps one of its rows too, that of the smallest hash of its text; so does one whose smallest id
    has several texts. Of rows with the same id and text one stays. All columns are kept.
    """
    with scope(docs.sparkSession, keep_last=True):
        groups = _grouped(docs, id_col, text_col, shingle_words, max_distance, similarity)
        chosen = groups.filter(F.col("id").eqNullSafe(F.col("group"))).groupBy("root")
        firsts = stage(chosen.agg(F.min("id").alias("first_id"), F.min("version").alias("first_version")).drop("root"))
    version = fresh(docs.columns, "version")
    own = docs.withColumn(version, version_of(F.col(text_col)))
    # Rows with and without id apart, so that each join is on plain equality and the last step needs no shuffle of its own.
    with_id, without_id = firsts.filter("first_id is not null"), firsts.filter("first_id is null")
    same_id = own[id_col].cast("long") == with_id["first_id"]
    named = own.join(with_id, same_id & (own[version] == with_id["first_version"]), "left_semi")
    unnamed = own.filter(F.col(id_col).isNull())
    nameless = unnamed.join(without_id, unnamed[version] == without_id["first_version"], "left_semi")
    return named.dropDuplicates([id_col, version]).unionByName(nameless.dropDuplicates([version])).drop(version)
