"""Token counts by batch encoding in Arrow functions that return lengths only.

Texts are encoded in slices of bounded bytes. A long text is cut where no piece of the model can reach across, its parts
are spread over all tasks, and their counts are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
import public_tokenizers
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.frames import batches_by_bytes, keyed, shuffle_width

#: Bytes of text that are encoded at a time.
BATCH_BYTES = 1 << 20
#: Texts of more bytes are cut into parts of about PART_BYTES.
LONG_BYTES = 1 << 16
PART_BYTES = 1 << 14
SPACE = "▁"


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=4)
def _pieces(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> tokenizers.Tokenizer:
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def splits_at_spaces(path: str) -> bool:
    """Whether the model's pieces let a text be cut before a space that follows something else: the model puts a
    space before the text, leaves all else as it is, and no piece holds a space behind another character."""
    if not path.endswith(".model"):
        return False
    model = _pieces(path)
    probe = ["a  b", " a", "a "]
    plain = [["".join(p) for p in [model.encode(t, out_type=str)]][0] for t in probe]
    keeps_spaces = plain == [SPACE + t.replace(" ", SPACE) for t in probe]
    return keeps_spaces and not any(SPACE in model.id_to_piece(i).lstrip(SPACE) for i in range(model.vocab_size()))


def lengths(path: str, texts: list[str]) -> list[int]:
    """Number of tokens of each text, without begin, end or added special tokens."""
    if path.endswith(".model"):
        return [len(ids) for ids in _pieces(path).encode(texts, num_threads=1)]
    return [len(e.ids) for e in _tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def parts(text: str, part_bytes: int = PART_BYTES) -> list[str]:
    """Parts whose token counts add up to that of ``text``, for a model that ``splits_at_spaces``.

    A cut takes away one space, which the model puts back before the next part. Where no space is safe, a part is
    longer.
    """
    found, start, at = [], 0, part_bytes
    while (at := text.find(" ", at)) > 0:
        if at + 1 == len(text):
            break
        if text[at - 1] in (" ", SPACE):
            at += 1
            continue
        found.append(text[start:at])
        start, at = at + 1, at + 1 + part_bytes
    return [*found, text[start:]]


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
        counted = pa.array(lengths(path, batch.column("text").to_pylist()), pa.int64())
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), counted], [*names, "n"])


def _cut(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
        for row in batch.to_pylist():
            cut = parts(row["text"]) if splits_at_spaces(path) else [row["text"]]
            yield pa.RecordBatch.from_pylist(
                [{**row, "part": i, "text": t} for i, t in enumerate(cut)],
                pa.schema([*batch.schema, pa.field("part", pa.int32())]),
            )


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str | None = None,
    limit: int = 4096,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit): one row per row of ``docs``.

    ``model_path`` names a tokenizer file that every executor has: ``.model`` for sentencepiece, ``.json`` for
    tokenizers. Null texts count as empty, with no tokens. Repeated rows and null ids stay. An empty table
    gives an empty result. Other columns are ignored.
    """
    path = model_path or default_model()
    texts = keyed(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = texts.filter(F.col("n_bytes") <= LONG_BYTES)
    counted = short.mapInArrow(partial(_count, path), "id long, n_bytes long, n long")

    # Equal long rows share a key: their parts add up to as many times the count.
    long = texts.filter(F.col("n_bytes") > LONG_BYTES).select("id", "n_bytes", F.md5("text").alias("hash"), "text")
    cut = long.mapInArrow(partial(_cut, path), "id long, n_bytes long, hash string, text string, part int")
    spread = cut.repartition(shuffle_width(docs), "id", "hash", "part")
    added = (
        spread.mapInArrow(partial(_count, path), "id long, n_bytes long, hash string, part int, n long")
        .groupBy("id", "n_bytes", "hash")
        .agg(F.sum("n").alias("n"), F.count_if(F.col("part") == 0).alias("rows"))
        .select("id", "n_bytes", F.expr("explode(array_repeat(n div rows, cast(rows as int)))").alias("n"))
    )
    return counted.unionByName(added).select(
        "id", "n_bytes", F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit")
    )
