"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them: each distinct run of first turns is one node, whose formatted
text is emitted once. Nodes are emitted depth-first. Each carries the position of its first token in its conversation
(equal for all that share it) and the stretches of the emitted stream that its tokens may attend to: those of the turns
before it. A token is a code point here, so that every tokenizer which keeps turn marks whole can work on the stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.frames import stage
from souk.operators.ordering import asc
from souk.operators.ranking import PART_SHIFT, ROW_ID, range_sorted

#: The marks of a turn. All control strings begin with one of OPENERS.
TURN_START, ROLE_END, TURN_END = "<s>[INST]", "[/INST]", "</s>"
OPENERS = "<["
LEARNT_ROLE = "assistant"


def escape(text: str) -> str:
    """A backslash behind every backslash and every character that can begin a control string: none is left."""
    return re.sub(r"([\\<\[])", r"\1\\", text)


def unescape(text: str) -> str:
    return re.sub(r"([\\<\[])\\", r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn with its marks, and where its text begins and ends."""
    head = f"{TURN_START}{escape(role)}{ROLE_END}"
    body = escape(text)
    return f"{head}{body}{TURN_END}", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(TURN_START, at):
            raise ValueError(f"no turn begins at {at}")
        role_end = formatted.index(ROLE_END, at)
        start = role_end + len(ROLE_END)
        end = formatted.index(TURN_END, start)
        role = formatted[at + len(TURN_START) : role_end]
        turns.append((unescape(role), unescape(formatted[start:end]), start, end))
        at = end + len(TURN_END)
    return turns


@dataclass(frozen=True)
class Packed:
    """``nodes``: one row per distinct run of first turns. ``paths``: which node each turn of a conversation is in."""

    nodes: DataFrame
    paths: DataFrame


def _lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each conversation its path: the digest of all turns up to each, and where it starts."""
    kind = pa.list_(
        pa.struct(
            [
                ("node", pa.binary()),
                ("role", pa.string()),
                ("text", pa.string()),
                ("position", pa.int64()),
                ("loss_start", pa.int64()),
                ("loss_end", pa.int64()),
            ]
        )
    )
    for batch in batches:
        paths = []
        for turns in batch.column("turns"):
            chain, position, path = b"", 0, []
            for turn in turns.as_py():
                role, text = turn["role"], turn["text"]
                formatted, start, end = format_turn(role, text)
                chain = hashlib.blake2b(chain + formatted.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                learnt = role == LEARNT_ROLE
                path.append(
                    {
                        "node": chain,
                        "role": role,
                        "text": formatted,
                        "position": position,
                        "loss_start": start if learnt else 0,
                        "loss_end": end if learnt else 0,
                    }
                )
                position += len(formatted)
            paths.append(path)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(paths, kind)], ["conv_id", "path"])


def _ancestors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the nodes that a conversation is the first to hold, the merged stretches of the turns before."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        nodes, attended = [], []
        for path in batch.column("path"):
            before: list[dict] = []
            for step in path.as_py():
                if step["owned"]:
                    nodes.append(step["node"])
                    attended.append([dict(x) for x in before])
                if before and before[-1]["end"] == step["start"]:
                    before[-1]["end"] = step["end"]
                else:
                    before.append({"start": step["start"], "end": step["end"]})
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(attended, kind)], ["node", "attends"])


def pack(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Packed:
    """The prefix tree of all conversations.

    ``nodes``: node, depth, role, text (formatted), start and end in the emitted stream, position (id of the
    first token), loss_start and loss_end (inside the text; equal if nothing is learnt), attends (stretches of the
    stream, its own excepted) and conversations (how many share it). ``paths``: conv_id, leaf (a number for each
    conversation), depth, node.
    Rows are ordered by turn, then role and text; repeated rows are turns of their own. Null roles and texts
    count as empty, a null turn comes first. Each row without conversation id is a conversation of one turn, so that no
    task gathers them. An empty table gives empty results. Other columns are ignored.
    """
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    named = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id")
    gathered = named.agg(F.sort_array(F.collect_list("t")).alias("turns")).unionByName(
        turns.filter(F.col("conv_id").isNull()).select("conv_id", F.array("t").alias("turns"))
    )
    step = "node binary, role string, text string, position long, loss_start long, loss_end long"
    laid = gathered.mapInArrow(_lay_out, f"conv_id {dict(turns.dtypes)['conv_id']}, path array<struct<{step}>>")
    laid = stage(laid.withColumn("row", F.monotonically_increasing_id()))

    # Ordered by their paths, the conversations below a node lie side by side.
    keyed = laid.select("row", "conv_id", F.col("path.node").alias("key"))
    leaves = range_sorted(keyed, [asc("key"), asc("conv_id"), asc("row")])
    numbered = laid.join(leaves.select("row", F.col(ROW_ID).alias("leaf")), "row")
    steps = numbered.select("conv_id", "leaf", F.posexplode("path").alias("depth", "step"))
    paths = stage(steps.select("conv_id", "depth", F.col("step.node").alias("node"), "leaf"))
    first = paths.groupBy("node").agg(
        F.min("leaf").alias("first_leaf"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("conversations")
    )
    # A node's text is taken from the conversation that holds it first.
    holder = first.withColumn("leaf", F.col("first_leaf"))
    own = steps.select("leaf", "step.*").join(holder, ["node", "leaf"]).drop("leaf")
    ordered = range_sorted(own, [asc("first_leaf"), asc("depth")])
    part = F.shiftright(F.col(ROW_ID), PART_SHIFT)
    sized = ordered.withColumns({"part": part, "size": F.char_length("text").cast("long")})
    # One row per partition of the sorted nodes.
    totals = sized.groupBy("part").agg(F.sum("size").alias("total"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("offset"))
    in_part = Window.partitionBy("part").orderBy(ROW_ID).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.join(F.broadcast(offsets), "part")
        .withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(in_part), F.lit(0)))
        .withColumn("end", F.col("start") + F.col("size"))
        .drop("part", "offset", "size", ROW_ID)
    )
    placed = stage(placed)

    spans = placed.select("node", "start", "end", "first_leaf")
    steps_of = (
        paths.join(spans, "node")
        .select("leaf", F.struct("depth", "node", "start", "end", (F.col("leaf") == F.col("first_leaf")).alias("owned")).alias("s"))
        .groupBy("leaf")
        .agg(F.sort_array(F.collect_list("s")).alias("path"))
    )
    attends = steps_of.mapInArrow(_ancestors, "node binary, attends array<struct<start:long,end:long>>")
    nodes = placed.join(attends, "node").drop("first_leaf")
    return Packed(nodes, paths.select("conv_id", "leaf", "depth", "node"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for parts in batch.column("parts"):
            found = parts.as_py()
            turns = read_turns("".join(p["text"] for p in found))
            loss = "".join(unescape(p["text"][p["loss_start"] : p["loss_end"]]) for p in found)
            said = "".join(f"{role}\n{text}\n" for role, text, _, _ in turns)
            size = sum(len(p["text"]) for p in found)
            rows.append((len(turns), _sha(said), len(loss), _sha(loss), size))
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds[1:]]
        arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *arrays], names)


def read_back(packed: Packed) -> DataFrame:
    """One row per conversation, put together again from the emitted nodes on its path: digests of its turns and of what
    lies under the loss mask."""
    texts = packed.nodes.select("node", "text", "loss_start", "loss_end")
    parts = (
        packed.paths.join(texts, "node")
        .groupBy("leaf", "conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "text", "loss_start", "loss_end"))).alias("parts"))
        .drop("leaf")
    )
    kind = dict(packed.paths.dtypes)["conv_id"]
    return parts.mapInArrow(
        _digest,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
