"""Whitening components of a vector table by shifted CholeskyQR.

The distinct vectors, as whole numbers and centred, are the rows of a tall matrix A. Each pass sums a Gram matrix over the
partitions, takes its triangular factor (with a small shift on the diagonal, so that it exists whatever the
condition of A) and solves the rows against it; after a few passes the rows are orthonormal and the product R of the
factors satisfies A = QR. Only the d x d matrices reach the driver. The singular values of R are those of A, so
its right singular vectors are the components, to the precision of R instead of that of a squared matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.frames import scope, stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Entries that are larger after scaling are not whole numbers of full precision; such vectors take no part.
LARGEST = float(1 << 52)
#: Passes at most; how near the Gram matrix of orthonormal rows must come to the identity.
PASSES, NEAR = 8, 1e-13
#: Shift of a pass, relative to the largest diagonal entry of its Gram matrix.
SHIFT = 1e-13
#: Directions whose deviation is smaller than this share of the largest have no variance but rounding.
RANK = 1e-10
#: Low bits of whole numbers that are summed apart, so that sums stay exact.
LOW = 26
#: Rows that a task treats at a time.
ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with exact ``sums``; unit ``components`` as columns, by falling ``variances``."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.components / np.sqrt(self.variances)


def whole(entry: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    return F.floor(F.lit(float(scale)) * entry.cast("double")) + F.lit(offset).cast("long")


def whole_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, offset: int = OFFSET
) -> DataFrame:
    """(id, x): the vectors that take part, as whole numbers floor(scale * c) + offset."""
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    # NaN compares as larger than any number.
    fits = F.forall("v", lambda c: c.isNotNull() & (F.abs(c * F.lit(float(scale))) < F.lit(LARGEST)))
    return own.filter(F.col("v").isNotNull() & fits).select("id", F.transform("v", lambda c: whole(c, scale, offset)).alias("x"))


def _padded(x: Column, width: int, offset: int) -> Column:
    """Vectors of fewer entries end in zeros, that is in ``offset`` as whole numbers."""
    return F.concat(x, F.array_repeat(F.lit(offset).cast("long"), F.lit(width) - F.size(x)))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _exact_sums(fitted: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in _slices(batches):
            x = _matrix(batch, width)
            n += len(x)
            high += (x >> LOW).sum(0)
            low += (x & ((1 << LOW) - 1)).sum(0)
        columns = [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(high), pa.array(low)]
        yield pa.RecordBatch.from_arrays(columns, ["i", "n", "high", "low"])

    summed = fitted.mapInArrow(run, "i int, n long, high long, low long").groupBy("i")
    rows = summed.agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    rows = sorted(rows, key=lambda r: r["i"])
    return (rows[0]["n"] if rows else 0), [(r["high"] << LOW) + r["low"] for r in rows]


def _centring(n: int, sums: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Each mean as a whole number and the rest below one, so that centring loses nothing of large offsets."""
    floors = [s // n for s in sums]
    return np.array(floors, np.int64), np.array([(s - f * n) / n for s, f in zip(sums, floors, strict=True)])


def _add(table: pa.Table) -> pa.Table:
    """Partial rows added in a fixed order."""
    rows = sorted(table.column("row").to_pylist())
    total = np.sum(np.array(rows), axis=0)
    return pa.table({"i": table.column("i")[:1], "row": pa.array([total.tolist()], pa.list_(pa.float64()))})


def gram(fitted: DataFrame, width: int, rows_of: Callable[[np.ndarray], np.ndarray], columns: int) -> np.ndarray:
    """The sum of M'M and, as one more row, of M, over all partitions, where M is ``rows_of`` their vectors.

    Each partition sends one row of numbers per dimension, and the rows of one dimension are added up in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((columns + 1, columns))
        for batch in _slices(batches):
            m = rows_of(_matrix(batch, width))
            total[:-1] += m.T @ m
            total[-1] += m.sum(0)
        rows = pa.array(total.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(columns + 1), pa.int32()), rows], ["i", "row"])

    summed = fitted.mapInArrow(run, "i int, row array<double>").groupBy("i").applyInArrow(_add, "i int, row array<double>")
    return np.array([r["row"] for r in sorted(summed.collect(), key=lambda r: r["i"])])


def solve_right(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Q with Q @ factor = rows, for an upper triangular factor, by substitution column after column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def shifted_factor(matrix: np.ndarray) -> np.ndarray:
    """The upper triangular factor of a Gram matrix, shifted so far that it exists."""
    values = np.linalg.eigvalsh(matrix)
    shift = 0.0 if values[0] > 0.5 * values[-1] else SHIFT * len(matrix) * max(values[-1], np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(len(matrix))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, SHIFT * max(values[-1], np.finfo(float).tiny))


def fit(vectors: DataFrame, k: int = COMPONENTS, offset: int = OFFSET) -> Whitening:
    """The first ``k`` whitening components of the distinct vectors in column ``x``.

    Directions without variance are no components, so there may be fewer than ``k``, and none if all vectors are equal.
    """
    with scope(vectors.sparkSession):
        width = vectors.agg(F.max(F.size("x")).alias("w")).first()["w"] or 0
        nothing = Whitening(0, [0] * width, np.zeros((width, 0)), np.zeros(0), np.zeros(0), 0.0)
        if not width:
            return nothing
        fitted = stage(vectors.select(_padded(F.col("x"), width, offset).alias("x")).distinct())
        n, sums = _exact_sums(fitted, width)
        if not n:
            return nothing
        floors, rests = _centring(n, sums)
        factors: list[np.ndarray] = []

        def orthogonalised(x: np.ndarray) -> np.ndarray:
            rows = (x - floors) - rests
            for factor in factors:
                rows = solve_right(rows, factor)
            return rows

        r = np.eye(width)
        for _ in range(PASSES):
            summed = gram(fitted, width, orthogonalised, width)[:-1]
            if np.abs(summed - np.eye(width)).max() < NEAR * width:
                break
            if not summed.any():  # all vectors are equal
                break
            factors = [*factors, shifted_factor(summed)]
            r = factors[-1] @ r
        if not factors:
            return Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), np.zeros(0), 0.0)
        _, deviations, right = np.linalg.svd(r)
        kept = deviations > RANK * deviations[0]
        variances = np.where(kept, deviations, 0.0) ** 2 / n
        few = min(k, int(kept.sum()))
        components = right[:few].T
        components = components * np.where(components[np.abs(components).argmax(0), range(few)] < 0, -1.0, 1.0)
        found = Whitening(n, sums, components, variances[:few], variances[:few] / variances.sum(), 0.0)

        checked = gram(fitted, width, lambda x: found.whitened((x - floors) - rests), few)
        covariance = checked[:-1] / n - np.outer(checked[-1], checked[-1]) / n**2
        error = float(np.abs(covariance - np.eye(few)).max())
        return Whitening(n, sums, components, found.variances, found.explained, error)


def deviations(x: np.ndarray, n: int, sums: Sequence[int]) -> list[int | None]:
    """The exact sum over dimensions of (n * x - sums) ** 2 of each row; None where a long cannot hold it."""
    floors = [s // n for s in sums]
    rests = [s - f * n for s, f in zip(sums, floors, strict=True)]
    # With t = x - floor, n * x - sum = n * t - rest.
    t = x - np.array(floors, np.int64)
    most, rest = int(np.abs(t).max(initial=0)), max(rests, default=0)
    exact = t if len(sums) * max(most * most, most * rest) < 1 << 62 else t.astype(object)
    squares = (exact * exact).sum(1).tolist()
    crossed = (exact * np.array(rests, exact.dtype)).sum(1).tolist()
    own = sum(r * r for r in rests)
    found = (n * n * s - 2 * n * c + own for s, c in zip(squares, crossed, strict=True))
    return [d if d < 1 << 63 else None for d in found]


def apply(vectors: DataFrame, model: Whitening, offset: int = OFFSET) -> DataFrame:
    """(id, deviation, whitened): every row of ``vectors`` with its exact squared deviation from the mean (times n
    squared; null where a long cannot hold it) and its whitened coordinates."""
    width = model.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not model.n:
            return
        floors, rests = _centring(model.n, model.sums)
        for batch in _slices(batches):
            x = _matrix(batch, width)
            values = model.whitened((x - floors) - rests)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1])
            columns = [
                batch.column("id"),
                pa.array(deviations(x, model.n, model.sums), pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(values.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "deviation", "whitened"])

    padded = vectors.select("id", _padded(F.col("x"), width, offset).alias("x"))
    return padded.mapInArrow(run, "id long, deviation long, whitened array<double>")


def whiten(
    vectors: DataFrame,
    k: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    offset: int = OFFSET,
) -> tuple[DataFrame, Whitening]:
    """((id, deviation, whitened), model): every row that takes part, whitened by the components of the distinct
    vectors, floor(scale * c) + offset.

    Vectors that are null, hold null or non-finite entries, or entries of ``LARGEST`` or more after scaling take no part;
    missing last entries count as zeros. Null ids and repeated rows stay; equal vectors count once for the fit.
    Vectors without any variance have no components and empty lists. An empty table gives an empty result. Other
    columns are ignored.
    """
    own = whole_vectors(vectors, id_col, vector_col, scale, offset)
    model = fit(own, k, offset)
    return apply(own, model, offset), model
