"""Alignment of two tokenizers over a corpus, each distinct text treated once.

Texts are shuffled by their full text, so that copies meet; each distinct text is tokenised and aligned once, and its pair
counts are weighted by the number of its copies. Two tokens are linked where their byte ranges overlap; byte offsets
at which a token of either tokenizer ends cut both sequences into groups. Measures of distinct texts go back to the documents
over a digest of the text.

Neither tokenizer looks across a space behind something that is not white space: the byte-level one splits there, and no
piece of the other holds a space behind another character. So a text falls into words that are aligned by
themselves, and a worker remembers them. All text between two such places, blanks and line ends included, is one word.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from souk.llm.frames import batches_by_bytes, keyed, stage
from souk.llm.token_counts import SPACE, splits_at_spaces

#: Bytes of text that are aligned at a time.
BATCH_BYTES = 1 << 20
#: Words whose alignment a worker remembers, and their longest, in characters.
WORDS = 400_000
LONGEST = 48
#: A table of pair counts of at most so many rows (12 bytes each, so 48 MB) goes to every executor; a larger one is joined.
BROADCAST_PAIRS = 4_000_000
# The splitting of a byte-level tokenizer file.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": None, "use_regex": True}


def default_paths() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is printable Latin-1 and no
    blank, else the next free letter from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligned(NamedTuple):
    """One stretch of text under both tokenizers: the number of A tokens, the groups as ``a1,a2|b1;a3|b2``, and the linked
    pairs as packed 32-bit codes, one for each link. Each place where a token ends closes one link, so there are as many
    links as tokens less groups."""

    n_a: int
    groups: str
    links: bytes

    @property
    def n_links(self) -> int:
        return len(self.links) // 4

    @property
    def n_groups(self) -> int:
        return self.groups.count(";") + 1

    @property
    def n_b(self) -> int:
        return self.n_links + self.n_groups - self.n_a


class Aligner:
    """Both tokenizers, and the words that this worker has aligned."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        size_a = self.a.get_vocab_size(with_added_tokens=True)
        tokens = [self.a.id_to_token(i) or "" for i in range(size_a)]
        self.bytes_a = [bytes(letters.get(c, 0) for c in t) for t in tokens]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))
        ]
        self.width = size_a
        self.sizes_a, self.sizes_b = np.array(list(map(len, self.bytes_a))), np.array(list(map(len, self.bytes_b)))
        names = [str(i) for i in range(max(size_a, len(self.bytes_b)))]
        self.inner, self.last_a, self.last_b = (np.array([n + x for n in names], object) for x in ",|;")
        # Whether words can be aligned by themselves: see above.
        form = json.loads(self.a.to_str())
        by_words = form["normalizer"] is None and form["pre_tokenizer"] | {"trim_offsets": None} == BYTE_LEVEL
        self.cuts = by_words and splits_at_spaces(path_b)
        if size_a * len(self.bytes_b) >= 1 << 31:
            raise ValueError("the vocabularies have too many pairs for 32-bit codes")
        self.known: dict[str, Aligned | None] = {}

    def align(self, text: str) -> Aligned | None:
        """The alignment of a whole text or word; None if the tokens' bytes are not those of space and text."""
        found = self._parts([text])
        return found[0] if found else None

    def _parts(self, words: list[str]) -> list[Aligned] | None:
        """The alignment of each word where all are encoded in one go; None if that does not come out even."""
        joined = " ".join(words)
        a, b = self.a.encode(" " + joined, add_special_tokens=False).ids, self.b.encode(joined)
        whole = (" " + joined).encode("utf-8", "surrogatepass")
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            return None
        a, b = np.array(a), np.array(b)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in words])
        cut_a, cut_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        if (ends_a[cut_a] != ends).any() or (ends_b[cut_b] != ends).any():
            return None
        # Wherever a token ends, one link ends: that of the two tokens that cover the place.
        sorted_ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        twice = sorted_ends[1:] == sorted_ends[:-1]
        either, both = sorted_ends[np.append(True, ~twice)], sorted_ends[1:][twice]
        links = b[np.searchsorted(ends_b, either)] * self.width + a[np.searchsorted(ends_a, either)]
        packed = links.astype(np.int32).tobytes()
        cut_links = (4 * (np.searchsorted(either, ends) + 1)).tolist()
        # Each id with what follows it, those of a group side by side, A before B.
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        said = np.concatenate(
            [
                np.where(both[group_a] == ends_a, self.last_a[a], self.inner[a]),
                np.where(both[group_b] == ends_b, self.last_b[b], self.inner[b]),
            ]
        )
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        said = said[order].tolist()
        cut_said = (cut_a + cut_b + 2).tolist()
        n_a = np.diff(cut_a, prepend=-1).tolist()
        found, from_said, from_links = [], 0, 0
        for n, to_said, to_links in zip(n_a, cut_said, cut_links, strict=True):
            found.append(Aligned(n, "".join(said[from_said:to_said])[:-1], packed[from_links:to_links]))
            from_said, from_links = to_said, to_links
        return found

    def learn(self, words: list[str]) -> None:
        """Align new words: all in one go, and one by one those that only the end of a text may have."""
        if len(self.known) + len(words) > WORDS:
            self.known.clear()
        together = [w for w in words if not open_end(w)]
        found = self._parts(together) if together else []
        if found is None:
            found = [self.align(w) for w in together]
        self.known.update(zip(together, found, strict=True))
        self.known.update((w, self.align(w)) for w in words if open_end(w))

    def texts(self, texts: list[str]) -> list[Aligned | None]:
        """The alignment of each text; None for an empty one and where the bytes differ."""
        cut = [(words(t) if self.cuts else [t]) if t else [] for t in texts]
        found = set().union(*cut)
        new = [w for w in found.difference(self.known) if len(w) <= LONGEST]
        if len(self.known) + len(new) > WORDS:  # the memory will be emptied: learn all words of these texts
            new = [w for w in found if len(w) <= LONGEST]
        if new:
            self.learn(new)
        long = {w: self.align(w) for w in found if len(w) > LONGEST}
        self.known.update(long)
        joined = [self._joined(list(map(self.known.__getitem__, own))) for own in cut]
        for w in long:
            del self.known[w]
        return joined

    @staticmethod
    def _joined(parts: list[Aligned | None]) -> Aligned | None:
        if not parts or None in parts:
            return None
        n_a, groups, links = zip(*parts, strict=True)
        return Aligned(sum(n_a), ";".join(groups), b"".join(links))


#: A space that no text may be cut before, at least not plainly.
UNEVEN = re.compile(rf"\A |[\s{SPACE}] | \Z")


def open_end(word: str) -> bool:
    """Whether a space behind the word could belong to what is in it."""
    return not word or word[-1].isspace() or word[-1] == SPACE


def words(text: str) -> list[str]:
    """Cut at each space that follows something else than white space or ``SPACE``, unless nothing follows it. The words, with
    a space between each two, are the text again, and none is empty."""
    found = text.split(" ")
    if not UNEVEN.search(text):
        return found
    out, held = [], None
    for i, w in enumerate(found):
        held = w if held is None else f"{held} {w}"
        last = i + 2 == len(found) and not found[-1]
        if not last and not open_end(held):
            out.append(held)
            held = None
    return out if held is None else [*out, held]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(text, copies): each text that is not empty once, shuffled by the full text."""
    texts = docs.select(F.col(text_col).alias("text")).filter("text <> ''")
    return texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


MEASURES = (
    "text_digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<int>, times array<int>"
)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts or [np.zeros(0, np.int32)])))


def _counted(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of a text's links, in order, and how often each occurs."""
    codes = np.sort(np.frombuffer(links, np.int32))
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.diff(first, append=len(codes))


def _measure(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        names = ["text_digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
        for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
            found = own.texts(batch.column("text").to_pylist())
            # Texts without tokens have no row: their measures are zero.
            rows = [i for i, f in enumerate(found) if f is not None]
            aligned = [found[i] for i in rows]
            counted = [_counted(f.links) for f in aligned]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(rows, pa.int64())) for c in ("text_digest", "copies")),
                    pa.array([f.n_a for f in aligned], pa.int64()),
                    pa.array([f.n_b for f in aligned], pa.int64()),
                    pa.array([f.n_groups for f in aligned], pa.int64()),
                    pa.array([f.n_links for f in aligned], pa.int64()),
                    pa.array([hashlib.sha256(f.groups.encode()).hexdigest() for f in aligned], pa.string()),
                    _lists([p for p, _ in counted]),
                    _lists([n.astype(np.int32) for _, n in counted]),
                ],
                names,
            )

    return run


def pair_counts(measured: DataFrame, width: int) -> DataFrame:
    """(pair, a, b, n, best): how many links of the corpus hold each pair of ids, and whether no other A id of the same B id
    has more."""
    each = measured.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    counted = each.groupBy(F.col("l.pairs").alias("pair")).agg(F.sum(F.col("copies") * F.col("l.times")).alias("n"))
    counted = counted.select("pair", F.expr(f"pair % {width}").alias("a"), F.expr(f"pair div {width}").cast("int").alias("b"), "n")
    counted = stage(counted)
    highest = counted.groupBy("b").agg(F.max("n").alias("highest"))
    return stage(counted.join(highest, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("highest")).alias("best")))


OWN = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _by_lookup(measured: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums by a table that every executor gets; its size has been checked."""
    # The sign says whether the pair is the commonest of its B id.
    rows = counts.select("pair", F.when(F.col("best"), -F.col("n")).otherwise(F.col("n")).alias("n")).toArrow()
    pairs, signed = rows.column("pair").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(pairs)
    shared = measured.sparkSession.sparkContext.broadcast((pairs[order], signed[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, signed = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            n = signed[np.searchsorted(pairs, own.flatten().to_numpy())]
            upto_best = np.concatenate([[0], np.cumsum(np.where(n < 0, times, 0))])
            upto = np.concatenate([[0], np.cumsum(np.abs(n) * times)])
            at = own.offsets.to_numpy() - own.offsets[0].as_py()
            names = ["text_digest", *OWN]
            sums = [pa.array(np.diff(u[at])) for u in (upto_best, upto)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *sums], [*names, "n_best", "count_sum"])

    kinds = "text_digest binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    return measured.drop("copies").mapInArrow(run, f"{kinds}, n_best long, count_sum long")


def _by_join(measured: DataFrame, counts: DataFrame) -> DataFrame:
    """The same sums by a join on the pairs, for a table of any size."""
    each = measured.select("text_digest", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    each = each.select("text_digest", F.col("l.pairs").alias("pair"), F.col("l.times").cast("long").alias("times"))
    weighed = each.join(counts.select("pair", "n", "best"), "pair")
    sums = weighed.groupBy("text_digest").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0).cast("long"))).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    return measured.select("text_digest", *OWN).join(sums, "text_digest")


def align_corpus(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """((id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), pair counts).

    The first table has a row per row of ``docs``, the second is that of ``pair_counts``. ``path_a`` names a byte-level file
    of the tokenizers library, ``path_b`` a sentencepiece model; every executor has both. Special tokens in texts
    are plain text. A link counts towards ``n_best`` if its pair is the commonest of its B id in the corpus, ties included;
    ``count_sum`` adds the corpus-wide counts of the links' pairs.

    Texts that are null or empty, or whose tokens' bytes are not those of space and text, have no tokens: zeros and an empty
    digest, and no share in the counts. Repeated rows and null ids stay. An empty table gives empty results. Other
    columns are ignored.
    """
    paths = (path_a or default_paths()[0], path_b or default_paths()[1])
    distinct = distinct_texts(docs, text_col).withColumn("text_digest", digest(F.col("text")))
    measured = stage(distinct.select("text", "text_digest", "copies").mapInArrow(_measure(paths), MEASURES))
    counts = pair_counts(measured, aligner(*paths).width)
    whole = (_by_lookup if counts.count() <= broadcast_pairs else _by_join)(measured, counts)
    named = keyed(docs, id_col, text_col).select("id", digest(F.col("text")).alias("text_digest"))
    found = named.join(whole, "text_digest", "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*OWN[:-1], "n_best", "count_sum")}
    return found.select("id", *zero.values(), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), counts


def alignments(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
) -> DataFrame:
    """(id, groups): the alignment itself, ``a1,a2|b1;a3|b2,b3`` with the ids of both tokenizers in order, a row per row of
    ``docs``; empty for texts without tokens (see ``align_corpus``)."""
    paths = (path_a or default_paths()[0], path_b or default_paths()[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
            found = [f.groups if f else "" for f in own.texts(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], ["id", "groups"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "id long, groups string")
