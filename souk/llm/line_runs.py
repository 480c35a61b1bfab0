"""Removing repeated runs of lines, found by a suffix array over the sequences of line ids.

Lines that occur once end a run, so only stretches of repeated lines with enough words in a row are looked at. The suffixes
of these stretches are ranked by prefix doubling: a suffix's rank by its first 2h lines follows from the ranks by h lines of
itself and of the suffix h lines on, and each round sorts the distinct pairs of these over all tasks. Equal
ranks are intervals of the suffix array whose common prefix has that many lines at least. The interval of suffixes that
share the first n lines, h <= n <= 2h, is given by the ranks by h lines at the first and at the n-h-th line on.

For each suffix n is the least number of lines with ``min_words`` words. In each interval of that depth the first suffix in
the order of documents stays and all later ones mark their n lines. A maximal repeated run of at least ``min_words``
words is the union of such marks, as every stretch of it that is long enough is a repeat itself. Doubling ends when h
covers the largest n.

All steps are DataFrame operations. Lines are known by 96 bits of hashes and their length; equal lines with many
copies are counted before they are sorted or joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.frames import fresh, scope, stage
from souk.operators.ordering import asc
from souk.operators.ranking import ROW_ID, range_sorted

MIN_WORDS = 50
LINE = ["h1", "h2", "length"]


def words_in(line: Column) -> Column:
    """Number of words between spaces, tabs, returns, form feeds and vertical tabs."""
    return F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))


def document_key(id_col: Column, text: Column) -> list[Column]:
    """What tells documents apart and orders them: the id (null last), then a hash of the text."""
    return [id_col.cast("long").alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version")]


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, version, pos, h1, h2, length, words): one staged row per line, without its text."""
    split = docs.select(
        *document_key(F.col(id_col), F.col(text_col)),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("pos", "line"),
    )
    return stage(
        split.select(
            "doc",
            "version",
            "pos",
            F.xxhash64("line").alias("h1"),
            F.hash("line").alias("h2"),
            F.octet_length("line").alias("length"),
            words_in(F.col("line")).alias("words"),
        )
    )


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """The lines in stretches of repeated lines with ``min_words`` words, with the number of their stretch (``seg``)."""
    # Written, so that the join has a shuffle of its own on either side, in which AQE can split a frequent line.
    repeated = stage(lines.groupBy(*LINE).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    own = lines.join(repeated, LINE)
    by_pos = Window.partitionBy("doc", "version").orderBy("pos")
    # Of rows that repeat a document, one stands for all.
    once = own.withColumn("r", F.row_number().over(Window.partitionBy("doc", "version", "pos").orderBy("words")))
    once = once.filter("r = 1").drop("r")
    # Consecutive positions keep their distance from the row number.
    numbered = once.withColumn("seg", F.col("pos") - F.row_number().over(by_pos))
    whole = Window.partitionBy("doc", "version", "seg")
    return stage(numbered.withColumn("all", F.sum("words").over(whole)).filter(F.col("all") >= min_words).drop("all"))


def needs(segments: DataFrame, min_words: int) -> DataFrame:
    """``segments`` with ``need``: how many lines from here on have ``min_words`` words (null if the stretch ends
    before)."""
    seg = ["doc", "version", "seg"]
    upto = Window.partitionBy(*seg).orderBy("pos")
    # A border is the place behind a line, at the words so far. A start looks for the first border min_words further on.
    summed = segments.withColumn("sum", F.sum("words").over(upto))
    # Each point carries its line, so that nothing is joined back and documents without id keep their lines.
    border = F.struct((F.col("pos") + 1).alias("at"), F.col("sum").alias("upto"))
    start = F.struct(F.lit(None).cast("int").alias("at"), (F.col("sum") - F.col("words") + F.lit(min_words)).alias("upto"))
    own = segments.columns
    points = summed.select(*own, F.explode(F.array(border, start)).alias("p")).select(*own, "p.*")
    # From the largest sum down, borders before starts of the same sum: the least border so far is the one wanted.
    down = Window.partitionBy(*seg).orderBy(F.desc("upto"), F.col("at").isNull(), F.desc("at"))
    found = points.withColumn("end", F.min("at").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    return found.filter("at is null").select(*own, (F.col("end") - F.col("pos")).alias("need"))


def _ranked(rows: DataFrame, pair: list[str]) -> DataFrame:
    """Distinct pairs with a rank that grows in their order."""
    distinct = rows.select(*pair).distinct()
    return range_sorted(distinct, [asc(c) for c in pair]).withColumnRenamed(ROW_ID, "rank")


def suffix_ranks(segments: DataFrame, depth: int) -> tuple[DataFrame, int]:
    """``segments`` with ``ranks``: the rank of each suffix by its first 1, 2, 4, ... lines, up to at most ``depth``.

    Suffixes end with their stretch; what ends sorts before what goes on.
    """
    first = _ranked(segments, LINE)
    ranked = segments.join(first, LINE).withColumn("ranks", F.array("rank")).drop(*LINE, "rank")
    on = Window.partitionBy("doc", "version", "seg").orderBy("pos")
    rounds, h = 1, 1
    while 2 * h <= depth:
        pairs = stage(
            ranked.withColumns(
                {
                    "own": F.element_at("ranks", -1),
                    "next": F.coalesce(F.lead(F.element_at("ranks", -1), h).over(on), F.lit(-1)),
                }
            )
        )
        doubled = _ranked(pairs, ["own", "next"])
        ranked = pairs.join(doubled, ["own", "next"])
        ranked = ranked.withColumn("ranks", F.concat("ranks", F.array("rank"))).drop("own", "next", "rank")
        rounds, h = rounds + 1, 2 * h
    return stage(ranked), rounds


@dataclass(frozen=True)
class Runs:
    """``later``: (doc, version, start, end, first_doc, first_pos), the repeated runs to delete, merged and without
    overlap; ``first_doc`` and ``first_pos`` say where the run's beginning occurs first."""

    later: DataFrame


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> Runs:
    """All later copies of runs of lines that have ``min_words`` words or more. See ``drop_repeated_runs``."""
    with scope(docs.sparkSession, keep_last=True):
        return Runs(stage(_later_copies(docs, id_col, text_col, min_words)))


def _later_copies(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    wanted = needs(stretches(lines_of(docs, id_col, text_col), min_words), min_words)
    segments = stage(wanted)
    depth = segments.agg(F.max("need")).first()[0] or 1
    ranked, rounds = suffix_ranks(segments, depth)

    # The level h with h <= need < 2h, and the ranks by h lines at the start and h lines before the end.
    level = F.least(F.floor(F.log2("need")) + 1, F.lit(rounds)).cast("int")
    starts = (
        ranked.filter("need is not null")
        .withColumn("level", level)
        .withColumn("tail_pos", (F.col("pos") + F.col("need") - F.pow(F.lit(2), F.col("level") - 1)).cast("int"))
        .withColumn("head", F.element_at("ranks", F.col("level")))
    )
    tails = ranked.select("doc", "version", F.col("pos").alias("tail_pos"), F.col("ranks").alias("tail_ranks"))
    same_doc = starts["doc"].eqNullSafe(tails["doc"]) & (starts["version"] == tails["version"])
    both = starts.join(tails, same_doc & (starts["tail_pos"] == tails["tail_pos"]))
    suffixes = both.select(
        starts["doc"],
        starts["version"],
        "pos",
        "need",
        "head",
        F.element_at("tail_ranks", F.col("level")).alias("tail"),
    )
    order = F.struct(F.col("doc").isNull().alias("n"), "doc", "version", "pos")
    interval = ["need", "head", "tail"]
    suffixes = stage(suffixes)
    intervals = suffixes.groupBy(*interval).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    marks = (
        suffixes.join(stage(intervals.filter("n > 1")), interval)
        .filter(order > F.col("first"))
        .withColumn("itself", F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("version") == F.col("first.version")))
        .withColumn("end", F.col("pos") + F.col("need"))
        # A run that overlaps its own first copy keeps that copy whole.
        .withColumn("start", F.when(F.col("itself"), F.greatest("pos", F.col("first.pos") + F.col("need"))).otherwise(F.col("pos")))
        .filter("start < end")
        .select("doc", "version", "start", "end", F.col("first.doc").alias("first_doc"), F.col("first.pos").alias("first_pos"))
    )
    # Merge overlapping and touching marks of a document.
    in_doc = Window.partitionBy("doc", "version").orderBy("start", "end")
    reached = F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    grouped = marks.withColumn("new", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int")).withColumn(
        "run", F.sum("new").over(in_doc.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = grouped.groupBy("doc", "version", "run").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min_by(F.struct("first_doc", "first_pos"), F.struct("start", "end")).alias("f"),
    )
    return merged.select("doc", "version", "start", "end", "f.*")


def drop_repeated_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    length_col: str | None = None,
) -> DataFrame:
    """``docs`` with later copies of repeated runs of lines taken out of the texts, plus ``n_lines`` and ``n_removed``.

    A run is one or more whole lines in a row, with ``min_words`` words or more together, that occur elsewhere in the same
    order. The first occurrence stays: in the document with the smallest id (null last; with one id, by a hash of the
    text), or first in its document; all others are deleted, and of a run that overlaps itself one whole copy stays. Lines
    are compared exactly, line ends are newlines. Repeated rows (same id and text) count as one document and all stay. A null
    text has one empty line and stays null. An empty table gives an empty result. All columns stay; ``length_col``, if
    given, is set to the new number of characters. Should ``docs`` have columns named like the added ones,
    underscores are put behind the added names.
    """
    runs = repeated_runs(docs, id_col, text_col, min_words).later
    cuts = runs.groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    own = ("n_lines", "n_removed", "_doc", "_version", "_lines", "_cuts", "_d", "_v")
    names = {c: fresh(docs.columns, c) for c in own}
    key, version = document_key(F.col(id_col), F.col(text_col))
    # The text travels as its lines, so that they are split once.
    prepared = docs.select(
        *(c for c in docs.columns if c != text_col),
        F.split(F.col(text_col), "\n").alias(names["_lines"]),
        key.alias(names["_doc"]),
        version.alias(names["_version"]),
    )
    # The cuts grow with the corpus: a sort-merge join at every size, never a broadcast.
    cuts = cuts.select(
        F.col("doc").alias(names["_d"]), F.col("version").alias(names["_v"]), F.col("cuts").alias(names["_cuts"])
    ).hint("merge")
    same = (F.col(names["_version"]) == F.col(names["_v"])) & F.col(names["_doc"]).eqNullSafe(F.col(names["_d"]))
    matched = prepared.join(cuts, same, "left")
    lines, cut = F.col(names["_lines"]), F.col(names["_cuts"])
    size = F.size(lines)
    # What lies between the cuts: from the end of one to the start of the next.
    begins = F.concat(F.array(F.lit(0)), F.transform(cut, lambda c: c["end"]))
    ends = F.concat(F.transform(cut, lambda c: c["start"]), F.array(size))
    kept = F.flatten(
        F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda r: F.slice(lines, r["a"] + 1, r["b"] - r["a"]))
    )
    removed = F.aggregate(cut, F.lit(0), lambda acc, c: acc + c["end"] - c["start"])
    text = F.when(cut.isNull(), F.array_join(lines, "\n")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    out = matched.select(
        *columns,
        F.coalesce(size, F.lit(1)).alias(names["n_lines"]),
        F.coalesce(removed, F.lit(0)).alias(names["n_removed"]),
    )
    if length_col:
        chars = F.char_length(F.coalesce(F.col(text_col), F.lit("")))
        out = out.withColumn(length_col, chars.cast(docs.schema[length_col].dataType))
    return out
