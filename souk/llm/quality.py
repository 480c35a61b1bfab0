"""Quality scores: ridge regression on random Fourier features of text statistics, calibrated by isotonic regression.

Random Fourier features turn a Gaussian kernel over the statistics into a linear model, so that training needs only the
sums X'X and X'y, which each partition adds up for itself. What reaches the driver has the size of the model.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.frames import keyed, scope, stage

#: Rows with a label that the model is fitted on at most, taken by a hash of their id. With more, all others only
#: get scores.
MAX_LABELLED = 400_000
FEATURES = 320
#: Width of the Gaussian kernel, in standard deviations of the statistics.
KERNEL_WIDTH = 6.0
RIDGE = 1e-3
SEED = 42
#: Raw scores are put into bins of this width before calibration.
BIN = 1 / 2048
SUM_PARTITIONS = 32
FOLDS = 5

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_CLASSES = np.stack(
    [
        _UPPER,
        _LETTER,
        np.isin(np.arange(256), list(b"0123456789")),
        np.isin(np.arange(256), list(b" \t\n\r")),
        np.isin(np.arange(256), list(b".,;:")),
        np.isin(np.arange(256), list(b"!?")),
        np.isin(np.arange(256), list(b"#$%&*@^~+=_\\")),
        np.isin(np.arange(256), list(b"|<>{}[]/")),
        np.isin(np.arange(256), list(b"'\"()-")),
    ]
).astype(np.float64)
STATISTICS = len(_CLASSES) + 11


def statistics(text: str) -> list[float]:
    """Numbers that describe the whole text, none of them its length in a way that a copy pasted twice would change
    much: shares of character classes, lengths and repeats of words and lines. All zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = _CLASSES @ np.bincount(data, minlength=256) / data.size
    n, lines = len(words), [x for x in text.split("\n") if x]
    counts = Counter(words)
    ends = sum(w[-1] in ".!?" for w in words)
    capitals = sum(w[0].isupper() for w in words)
    shouted = sum(w.isupper() and len(w) > 1 for w in words)
    plain = sum(w.isalpha() for w in words)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lengths = np.fromiter(map(len, words), np.float64, n)
    return [
        *shares.tolist(),
        math.log1p(n) / 5,
        float(lengths.mean()) / 5,
        float(lengths.std()) / 5,
        len(counts) / n**0.8,
        counts.most_common(1)[0][1] / n,
        same / n,
        ends / n,
        capitals / n,
        shouted / n,
        plain / n,
        len(set(lines)) / max(1, len(lines)),
    ]


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats): one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array([statistics(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), stats], ["id", "stats"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "id long, stats array<double>")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    levels: np.ndarray  # raw scores at which the calibrated score is known, and that score
    scores: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = (stats - self.mean) / self.scale
        waves = np.cos(z @ self.waves + self.phases) * math.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(stats), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        return np.clip(np.interp(self.raw(stats), self.levels, self.scores), 0.0, 1.0)


def isotonic(level: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nondecreasing fit to ``mean`` in the order of ``level``, by pooling neighbours that are out of order."""
    blocks: list[list[float]] = []  # mean, weight, first level, last level
    for x, y, w in zip(level, mean, weight, strict=True):
        blocks.append([y, w, x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            y2, w2, _, last = blocks.pop()
            top = blocks[-1]
            top[0] = (top[0] * top[1] + y2 * w2) / (top[1] + w2)
            top[1] += w2
            top[3] = last
    ends = [(x, b[0]) for b in blocks for x in dict.fromkeys((b[2], b[3]))]
    return np.array([x for x, _ in ends]), np.array([y for _, y in ends])


def held_out(id_: str | Column) -> Column:
    """Whether a row's label must not be learnt: CRC-32 of the id as text, modulo 5, is 0. Null ids are not held out."""
    return F.coalesce(fold(id_) == 0, F.lit(False))


def fold(id_: str | Column) -> Column:
    return F.crc32(F.col(id_).cast("string") if isinstance(id_, str) else id_.cast("string")) % FOLDS


def _sums(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = model.features(np.array(batch.column("stats").to_pylist()))
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
            total += x.T @ np.concatenate([x, y[:, None]], axis=1)
        rows = pa.array(total.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(FEATURES + 1), pa.int32()), rows], ["i", "row"])

    return run


def _add(table: pa.Table) -> pa.Table:
    total = np.sum(np.array(table.column("row").to_pylist()), axis=0)
    return pa.table({"i": table.column("i")[:1], "row": pa.array([total.tolist()], pa.list_(pa.float64()))})


def learnable(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(id, label): the labels 0 and 1 that may be learnt, about ``MAX_LABELLED`` at most."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter("id is not null and label in (0, 1)")
        .filter(~held_out("id"))
    )
    rows = known.count()
    if rows > MAX_LABELLED:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(MAX_LABELLED / rows * (1 << 20))))
    return known


def _labelled(stats: DataFrame, known: DataFrame) -> DataFrame:
    return stage(stats.join(known, "id").withColumn("calibrates", fold("id") == 1))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """A model from (id, stats) rows and their labels 0 and 1.

    Held-out ids are left out; of the others one fold calibrates and the rest are summed into the normal equations. At
    most about ``MAX_LABELLED`` labelled rows are used. Without labels of both kinds every score is the share of ones (0.5
    without labels).
    """
    known = learnable(labels, id_col, label_col)
    with scope(labels.sparkSession):
        return _fit(_labelled(stats, known))


def _fit(joined: DataFrame) -> Model:
    """A model from (id, stats, label, calibrates) rows."""
    each = [F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(STATISTICS)]
    each += [F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(STATISTICS)]
    row = joined.agg(F.count_if(F.col("label") == 1).alias("ones"), F.count(F.lit(1)).alias("n"), *each).first()
    draw = np.random.default_rng(SEED)
    waves = draw.normal(0, 1 / KERNEL_WIDTH, (STATISTICS, FEATURES))
    phases = draw.uniform(0, 2 * math.pi, FEATURES)
    if row["ones"] in (0, row["n"]):
        share = row["ones"] / row["n"] if row["n"] else 0.5
        flat = np.zeros(STATISTICS)
        return Model(flat, flat + 1, waves, phases, np.zeros(FEATURES + 1), np.zeros(1), np.array([share]))
    mean = np.array([row[f"m{i}"] for i in range(STATISTICS)])
    scale = np.array([row[f"s{i}"] for i in range(STATISTICS)])
    unfitted = Model(mean, np.where(scale > 1e-9, scale, 1.0), waves, phases, np.zeros(0), np.zeros(0), np.zeros(0))

    fitted_on = joined.filter("not calibrates") if joined.filter("not calibrates").take(1) else joined
    summed = (
        fitted_on.select("stats", "label")
        .coalesce(SUM_PARTITIONS)
        .mapInArrow(_sums(unfitted), "i int, row array<double>")
        .groupBy("i")
        .applyInArrow(_add, "i int, row array<double>")
    )
    sums = np.array([r["row"] for r in sorted(summed.collect(), key=lambda r: r["i"])])
    n = sums[-1, -2]
    weights = np.linalg.solve(sums[:, :-1] + RIDGE * n / FEATURES * np.eye(FEATURES + 1), sums[:, -1])
    raw_model = Model(mean, unfitted.scale, waves, phases, weights, np.zeros(0), np.zeros(0))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = np.round(raw_model.raw(np.array(batch.column("stats").to_pylist())) / BIN)
                bins = np.clip(bins, -2 / BIN, 3 / BIN).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], ["bin", "label"])

    calibrating = joined.filter("calibrates") if joined.filter("calibrates").take(1) else joined
    binned = (
        calibrating.select("stats", "label")
        .mapInArrow(raw, "bin long, label int")
        .groupBy("bin")
        .agg(F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .collect()
    )
    levels, scores = isotonic(
        np.array([r["bin"] * BIN for r in binned]),
        np.array([r["mean"] for r in binned]),
        np.array([float(r["n"]) for r in binned]),
    )
    return Model(mean, unfitted.scale, waves, phases, weights, levels, scores)


def score_text(model: Model, text: Column) -> Column:
    """The score of a text column, for filtering a table in place. Null counts as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(t) for t in texts]).reshape(-1, STATISTICS)))

    return score(F.coalesce(text, F.lit("")))


def score_statistics(model: Model, stats: DataFrame) -> DataFrame:
    """(id, score) of (id, stats) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("stats").flatten().to_numpy().reshape(-1, STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(values))], ["id", "score"])

    return stats.mapInArrow(run, "id long, score double")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """(id, held_out, score, predicted): one row per row of ``docs``; higher scores mean that label 1 is likelier.

    Only the text is looked at. Null texts count as empty and get the score of a text without words. Null ids are
    scored and not held out. Labels that are null or neither 0 nor 1 are ignored; a row with several labels counts with
    each. An empty table gives an empty result. Other columns are ignored.
    """
    stats = stage(text_statistics(docs, id_col, text_col))
    scored = score_statistics(fit(stats, labels, id_col, label_col), stats)
    return scored.select(
        "id", held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns. The model is that of
    ``quality_scores``; to fit it, only texts with a label are looked at."""
    with scope(docs.sparkSession):
        known = stage(learnable(labels, id_col, label_col))
        texts = keyed(docs, id_col, text_col).join(known.select("id").distinct(), "id", "left_semi")
        model = _fit(_labelled(text_statistics(texts, "id", "text"), known))
    return docs.filter(score_text(model, docs[text_col]) >= threshold)
