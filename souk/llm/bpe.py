"""BPE encoding and decoding with the results of the tokenizers library.

Most texts are encoded word by word with the words' tokens remembered. A long text is cut at white space into chunks that are
encoded in parallel. Where white space is too far apart, the unsplit text is halved until the parts are short, the parts
are encoded in parallel, and neighbours are joined as a tree: around each join a window of text is
encoded anew, and it grows until its first token is one the left side has at the same place and some later token is
one the right side has. A BPE encoding is right as soon as each two neighbouring tokens are the encoding of the
text they cover together, so the tokens before, inside and behind the window then form the encoding of the whole.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from souk.llm.frames import batches_by_bytes, keyed, shuffle_width

#: Bytes of text that are encoded at a time.
BATCH_BYTES = 1 << 20
#: Texts of more bytes are cut into chunks of at most PART_CHARS characters; unsplit text that is twice as long, into halves.
LONG_BYTES = 1 << 16
PART_CHARS = 1 << 13
#: First width of the window on either side of a join, in bytes.
WINDOW = 64
#: Words whose tokens a worker remembers.
WORDS = 400_000
#: Texts of these characters only are split here as the library would; all others go to the library as a whole.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ɏ]*")
# The split pattern of the vocabulary file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD = regex.compile(SPLIT)
BLANK = re.compile(r"[ \n]")
WORD_END = "</w>"


def default_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class Codec:
    """Encoder and decoder of one vocabulary file, kept by each Python worker."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ids = range(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in ids]
        self.ends = [t.endswith(WORD_END) for t in self.tokens]
        self.special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len)
        self.special_split = re.compile("(" + "|".join(map(re.escape, reversed(self.special))) + ")")
        self.words: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Encode new words in one go; a token that ends a word closes it."""
        if len(self.words) > WORDS:
            self.words.clear()
        new = [w for w in words if w not in self.words]
        held, at, ends = array("i"), 0, self.ends
        for i in self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids:
            held.append(i)
            if ends[i]:
                self.words[new[at]] = held.tobytes()
                held, at = array("i"), at + 1

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as packed 32-bit integers."""
        split: list[list[str] | None] = []
        for text in texts:
            if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
                split.append(WORD.findall(unicodedata.normalize("NFC", text).lower()))
            else:
                split.append(None)
        if unknown := {w for words in split if words for w in words if w not in self.words}:
            self._learn(unknown)
            if len(self.words) == len(unknown):  # the memory was emptied: it lacks the others of this batch
                self._learn({w for words in split if words for w in words})
        known = self.words
        return [
            array("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            if words is None
            else b"".join([known[w] for w in words])
            for text, words in zip(texts, split, strict=True)
        ]

    def decode(self, ids: np.ndarray) -> str:
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])

    def sections(self, text: str) -> list[tuple[bool, str]]:
        """The text between special strings, normalised, and the special strings themselves."""
        normal = self.tokenizer.normalizer.normalize_str
        return [
            (bool(i % 2), t if i % 2 else normal(t)) for i, t in enumerate(self.special_split.split(text)) if t
        ]

    def spans(self, text: str, start: int = 0) -> Spans:
        """Tokens of normalised text, with their places in its UTF-8 bytes from ``start`` on."""
        found = Spans()
        # Places of pre-tokens count characters; those of tokens inside count bytes.
        at_byte = np.zeros(len(text) + 1, np.int64)
        if text:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=at_byte[1:])
        for word, (a, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            at = start + int(at_byte[a])
            for token in self.tokenizer.model.tokenize(word):
                end = at + len(token.value.removesuffix(WORD_END))
                found.ids.append(token.id)
                found.starts.append(at)
                found.ends.append(end)
                at = end
        return found

    def join(self, text: bytes, left: Spans, right: Spans, cut: int, low: int, high: int) -> Spans:
        """The encoding of text[low:high] from those of text[low:cut] and text[cut:high]."""
        width = WINDOW
        while True:
            i = bisect_right(left.starts, cut - width) - 1
            while i > 0 and text[left.starts[i]] & 0xC0 == 0x80:
                i -= 1
            j = bisect_left(right.ends, cut + width)
            while j < len(right.ids) and right.ends[j] < high and text[right.ends[j]] & 0xC0 == 0x80:
                j += 1
            a = left.starts[i] if i > 0 else low
            b = right.ends[j] if j < len(right.ids) else high
            window = self.spans(text[a:b].decode("utf-8", "surrogatepass"), a)
            whole_left, whole_right = i <= 0, j >= len(right.ids)
            agrees = whole_left or (window.ids and window.at(0) == left.at(i))
            meet = None if whole_right else window.last_common(right)
            if agrees and (whole_right or meet):
                u, v = meet or (len(window.ids) - 1, len(right.ids) - 1)
                return Spans.chain(left.part(0, max(i, 0)), window.part(0, u + 1), right.part(v + 1, None))
            width *= 2

    def tree(self, text: bytes, encoded: list[tuple[int, int, Spans]]) -> Spans:
        """Join neighbouring (low, high, tokens) parts until one is left."""
        while len(encoded) > 1:
            pairs = [
                (a[0], b[1], self.join(text, a[2], b[2], b[0], a[0], b[1]))
                for a, b in zip(encoded[::2], encoded[1::2], strict=False)
            ]
            encoded = pairs + encoded[len(pairs) * 2 :]
        return encoded[0][2] if encoded else Spans()


class Spans:
    """Token ids with the bytes that each covers."""

    def __init__(self, ids=(), starts=(), ends=()) -> None:
        self.ids, self.starts, self.ends = list(ids), list(starts), list(ends)

    def at(self, i: int) -> tuple[int, int, int]:
        return self.ids[i], self.starts[i], self.ends[i]

    def part(self, a: int, b: int | None) -> Spans:
        return Spans(self.ids[a:b], self.starts[a:b], self.ends[a:b])

    def last_common(self, right: Spans) -> tuple[int, int] | None:
        """Places in both of the last token of this that ``right`` has too."""
        for u in range(len(self.ids) - 1, -1, -1):
            v = bisect_left(right.starts, self.starts[u])
            if v < len(right.ids) and right.at(v) == self.at(u):
                return u, v
        return None

    @staticmethod
    def chain(*parts: Spans) -> Spans:
        joined = Spans()
        for p in parts:
            joined.ids += p.ids
            joined.starts += p.starts
            joined.ends += p.ends
        return joined


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def halves(low: int, high: int, most: int) -> list[tuple[int, int]]:
    """Cut [low, high) into halves, and those again, until none is longer than ``most``."""
    if high - low <= most:
        return [(low, high)]
    middle = (low + high) // 2
    return halves(low, middle, most) + halves(middle, high, most)


def _lists(packed: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _encode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
        ids = _lists(codec(path).encode(batch.column("text").to_pylist()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), ids], ["id", "ids"])


def chunks(text: str, most: int = PART_CHARS) -> list[str]:
    """Cut before white space, where neither normalising nor splitting looks across, so that no chunk has more than
    ``most`` characters unless white space is further apart."""
    found, start = [], 0
    while len(text) - start > most:
        at = max(text.rfind(" ", start + 1, start + most), text.rfind("\n", start + 1, start + most))
        if at < 0:
            ahead = BLANK.search(text, start + most)
            if not ahead:
                break
            at = ahead.start()
        found.append(text[start:at])
        start = at
    return [*found, text[start:]]


#: Kinds of parts: the row itself, a chunk to encode as it is, a special string, and a part of unsplit text.
ROW, CHUNK, SPECIAL, PIECE = range(4)
PART_SCHEMA = "id long, hash string, section int, kind int, low int, high int, text string"


def _cut(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "hash", "section", "kind", "low", "high", "text"]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
        for id_, hash_, text in zip(*(batch.column(c).to_pylist() for c in ("id", "hash", "text")), strict=True):
            rows = [(id_, hash_, -1, ROW, 0, 0, "")]  # one row at least, whatever is left of the text
            section = 0
            for chunk in chunks(text):
                if len(chunk) <= 2 * PART_CHARS:
                    rows.append((id_, hash_, section, CHUNK, 0, len(chunk), chunk))
                    section += 1
                    continue
                for special, part in codec(path).sections(chunk):
                    for a, b in [(0, len(part))] if special else halves(0, len(part), PART_CHARS):
                        rows.append((id_, hash_, section, SPECIAL if special else PIECE, a, b, part[a:b]))
                    section += 1
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)


ENCODED_SCHEMA = f"{PART_SCHEMA}, ids array<int>, starts array<int>, ends array<int>"


def _encode_parts(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encode each part by itself; the places of an unsplit text's tokens count bytes of the part."""
    own = codec(path)
    for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
        kinds, texts = batch.column("kind").to_pylist(), batch.column("text").to_pylist()
        plain = iter(own.encode([t for k, t in zip(kinds, texts, strict=True) if k == CHUNK]))
        found = []
        for kind, text in zip(kinds, texts, strict=True):
            if kind == CHUNK:
                found.append(Spans(np.frombuffer(next(plain), np.int32)))
            elif kind == SPECIAL:
                found.append(Spans([own.tokenizer.token_to_id(text)]))
            else:
                found.append(own.spans(text))
        lists = [pa.array([getattr(s, c) for s in found], pa.list_(pa.int32())) for c in ("ids", "starts", "ends")]
        yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "ids", "starts", "ends"])


def _join_parts(path: str):
    def run(table: pa.Table) -> pa.Table:
        """All parts of one text to its ids, once for each row that has this id and text."""
        rows = sorted(table.to_pylist(), key=lambda r: (r["section"], r["low"], r["high"]))
        count = sum(r["kind"] == ROW for r in rows)
        own, ids = codec(path), []
        # Equal rows have equal parts, which lie side by side.
        for _, group in groupby(rows[count:][::count], key=lambda r: r["section"]):
            of_section, at, encoded = list(group), 0, []
            if of_section[0]["kind"] != PIECE:
                ids += of_section[0]["ids"]
                continue
            for r in of_section:
                size = len(r["text"].encode("utf-8", "surrogatepass"))
                moved = Spans(r["ids"], (at + x for x in r["starts"]), (at + x for x in r["ends"]))
                encoded.append((at, at + size, moved))
                at += size
            text = "".join(r["text"] for r in of_section).encode("utf-8", "surrogatepass")
            ids += own.tree(text, encoded).ids
        first = table.column("id")[0].as_py()
        lists = pa.array([ids] * count, pa.list_(pa.int32()))
        return pa.table({"id": pa.array([first] * count, pa.int64()), "ids": lists})

    return run


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """(id, ids): the token ids of every text, one row per row of ``docs``.

    ``vocabulary`` names a file of the tokenizers library that every executor has, with word ends and the
    split pattern ``SPLIT``. Null texts count as empty and have no ids. Repeated rows and null ids stay. An empty table
    gives an empty result. Other columns are ignored.
    """
    path = vocabulary or default_vocabulary()
    texts = keyed(docs, id_col, text_col)
    long = F.octet_length("text") > LONG_BYTES
    short = texts.filter(~long).mapInArrow(partial(_encode, path), "id long, ids array<int>")
    parts = (
        texts.filter(long)
        .select("id", F.md5("text").alias("hash"), "text")
        .mapInArrow(partial(_cut, path), PART_SCHEMA)
        .repartition(shuffle_width(docs), "id", "hash", "section", "low")
        .mapInArrow(partial(_encode_parts, path), ENCODED_SCHEMA)
    )
    joined = parts.groupBy("id", "hash").applyInArrow(_join_parts(path), "id long, ids array<int>")
    return short.unionByName(joined)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(id, ids, text): what the library's ``decode`` gives for each list of ids, special tokens included. The
    vocabulary has no decoder, so tokens stand as they are, with a space between them."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [own.decode(ids.values.to_numpy()) for ids in rows.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("ids"), pa.array(texts, pa.string())], ["id", "ids", "text"]
                )

    return encoded.select("id", "ids").mapInArrow(run, "id long, ids array<int>, text string")
