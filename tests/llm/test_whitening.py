"""Whitening components against a direct eigendecomposition, and exact columns against whole numbers of any size."""

import math

import duckdb
import numpy as np
import pytest
from conftest import SF

from souk.llm import queries, whitening

ROWS = "vec_id long, embedding array<double>, id int, x string, whitened string, n int"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], ROWS)


def direct(vectors):
    """(x, n, sums, eigenvalues, eigenvectors) by plain numpy."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    values, basis = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, len(fit), [int(s) for s in fit.astype(object).sum(0)], values[::-1], basis[:, ::-1]


def test_query_agrees_with_a_direct_solution(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet' order by vec_id").fetchall()
    x, n, sums, values, basis = direct([v for _, v in rows])
    found = {(r.vec_id, r.component): r for r in queries.op13_whitening(spark, SF).collect()}
    assert len(found) == 16 * len(rows)
    wanted = (x - np.array(sums) / n) @ basis[:, :16] / np.sqrt(values[:16])
    got = np.array([[found[i, c + 1].whitened for c in range(16)] for i, _ in rows])
    signs = np.sign((got * wanted).sum(0))
    assert np.abs(got * signs - wanted).max() < 1e-8
    for (i, _), own in zip(rows, x.tolist(), strict=True):
        r = found[i, 1]
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(own, sums, strict=True)) and r.n == n
    first = [found[rows[0][0], c + 1] for c in range(16)]
    assert np.allclose([r.explained for r in first], values[:16] / values.sum(), rtol=1e-9)
    assert {r.identity_error for r in found.values()} == {first[0].identity_error} and first[0].identity_error < 1e-9


def test_ill_conditioned_vectors(spark):
    draw = np.random.default_rng(5)
    spread = np.array([1e7, 1e5, 1e3, 10.0, 1.0])
    vectors = (draw.normal(size=(400, 5)) * spread) @ np.linalg.qr(draw.normal(size=(5, 5)))[0]
    rows, model = whitening.whiten(rows_of(spark, list(enumerate(vectors.tolist()))), k=5)
    x, n, sums, values, _ = direct(vectors)
    singular = np.linalg.svd(x - np.array(sums) / n, compute_uv=False)
    assert np.allclose(model.variances, singular**2 / n, rtol=1e-6) and model.identity_error < 1e-6
    white = np.array([r.whitened for r in rows.collect()])
    assert np.abs(white.T @ white / n - np.eye(5)).max() < 1e-6


def test_directions_without_variance_are_left_out(spark):
    draw = np.random.default_rng(6)
    vectors = [[a, a, 3.0, b, a + b] for a, b in draw.normal(size=(50, 2)).round(1).tolist()]
    rows, model = whitening.whiten(rows_of(spark, list(enumerate(vectors))))
    x, n, sums, values, _ = direct(vectors)
    kept = int((values > 1e-9 * values[0]).sum())
    assert model.components.shape == (5, kept) and np.allclose(model.variances, values[:kept], rtol=1e-9)
    assert model.identity_error < 1e-9 and {len(r.whitened) for r in rows.collect()} == {kept}


def test_odd_rows(spark):
    good = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(40)]
    odd = [
        (90, None),
        (91, [1.0, None, 2.0]),
        (92, [1.0, float("nan"), 2.0]),
        (93, [float("inf"), 0.0, 0.0]),
        (94, [1e300, 0.0, 0.0]),
        (95, [0.0, 0.0, 0.0]),
        (96, []),
        (97, [2.0]),
        (None, [1.0, 1.0, 1.0]),
        (3, [3.0, 3.0, 1.0]),
    ]
    rows, model = whitening.whiten(rows_of(spark, good + odd))
    taking = [(i, [*v, 0.0, 0.0, 0.0][:3]) for i, v in good + odd[5:]]
    _, n, sums, _, _ = direct([v for _, v in taking])
    assert (model.n, model.sums) == (n, sums)
    found = rows.collect()
    assert sorted(str(r.id) for r in found) == sorted(str(i) for i, _ in taking)
    assert all(np.isfinite(r.whitened).all() for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_no_vectors(spark, rows):
    found, model = whitening.whiten(rows_of(spark, rows))
    assert model.components.shape[1] == 0 and all(r.whitened == [] for r in found.collect())


def test_equal_vectors_count_once_and_have_no_components(spark):
    found, model = whitening.whiten(rows_of(spark, [(i, [1.5, -2.0]) for i in range(9)]))
    assert model.n == 1 and model.components.shape == (2, 0)
    assert sorted((r.id, r.deviation, list(r.whitened)) for r in found.collect()) == [(i, 0, []) for i in range(9)]


def test_a_common_vector_counts_once(spark):
    draw = np.random.default_rng(8).normal(size=(60, 4)).tolist()
    plain, hot = rows_of(spark, list(enumerate(draw))), rows_of(spark, list(enumerate(draw + [draw[0]] * 300)))
    a, b = whitening.whiten(plain)[1], whitening.whiten(hot)[1]
    assert (a.n, a.sums) == (b.n, b.sums) and np.allclose(a.components, b.components, atol=1e-12)


@pytest.mark.parametrize("size", [10, 1 << 20, 1 << 40, 1 << 52])
def test_deviations_are_exact(size):
    draw = np.random.default_rng(9)
    x = draw.integers(-size, size, (30, 3))
    n, sums = 12345, [int(s) for s in draw.integers(-size, size, 3).astype(object) * 12345 // 7]
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
    assert whitening.deviations(x, n, sums) == [d if d < 1 << 63 else None for d in exact]


def test_triangular_solve():
    draw = np.random.default_rng(10)
    factor = np.triu(draw.normal(size=(6, 6))) + 4 * np.eye(6)
    rows = draw.normal(size=(20, 6))
    assert np.allclose(whitening.solve_right(rows, factor) @ factor, rows)
