"""Truncated SVD over tables against NumPy."""

import numpy as np
import pytest

from ratewise.operators import randomized_svd as R


def matrix(rows, columns, seed, decay=0.7, density=0.25):
    """A sparse matrix with falling singular values."""
    rng = np.random.default_rng(seed)
    rank = min(rows, columns)
    full = rng.normal(size=(rows, rank)) * decay ** np.arange(rank) @ rng.normal(size=(rank, columns))
    return np.where(rng.random((rows, columns)) < density, full, 0.0) + np.outer(np.arange(rows) % 3, np.arange(columns) % 5) * 1.0


def cells(spark, a, ids=None):
    found = [(int(i if ids is None else ids[i]), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    return spark.createDataFrame(found, "id long, idx int, value double")


def dense(table, key, columns, n):
    out = None
    for r in table.collect():
        row = np.concatenate([np.array(r[c]) for c in columns])
        out = np.zeros((n, len(row))) if out is None else out
        out[r[key]] = row
    return out


def vectors(found, n):
    return dense(found.vectors, "idx", [c for c in found.vectors.columns if c != "idx"], n)


@pytest.mark.parametrize("panel", [8, 32])
def test_equals_numpy(spark, panel):
    """Eight components stand out; what is left is a thousandth of them."""
    rng = np.random.default_rng(1)
    strong = rng.normal(size=(60, 8)) @ np.diag(2.0 ** np.arange(8, 0, -1)) @ rng.normal(size=(8, 40))
    a = strong + rng.normal(size=(60, 40)) * 1e-3
    a[:, 39] = 0
    found = R.truncated_svd(cells(spark, a), 8, passes=2, panel=panel)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    assert found.k == 8 and np.allclose(found.singular, s[:8], rtol=1e-6)
    v = np.vstack([vectors(found, 39), np.zeros(8)])
    assert v.shape == (40, 8) and np.allclose(v.T @ v, np.eye(8), atol=1e-9)
    projected = dense(found.project(cells(spark, a)), "id", ["z"], 60)
    assert np.allclose(projected, a @ v, atol=1e-9)
    assert np.allclose(np.abs(projected), np.abs(u[:, :8] * s[:8]), atol=1e-4)


def test_energy_of_a_slow_spectrum(spark):
    a = matrix(150, 120, 2, decay=0.98, density=0.5)
    found = R.truncated_svd(cells(spark, a), 20, passes=3)
    v = vectors(found, 120)
    best = (np.linalg.svd(a, compute_uv=False)[:20] ** 2).sum()
    assert np.allclose(v.T @ v, np.eye(20), atol=1e-9)
    assert best * 0.98 <= (np.linalg.norm(a @ v) ** 2) <= best * (1 + 1e-9)
    assert np.isclose((found.singular**2).sum(), np.linalg.norm(a @ v) ** 2)


def test_more_components_than_rank(spark):
    a = np.outer(np.arange(1, 13), np.arange(1, 8)) * 1.0
    a[:, 6] = 0
    a[:, 5] = np.arange(12) % 2
    found = R.truncated_svd(cells(spark, a), 50)
    assert found.k == 2
    assert np.allclose(found.singular, np.linalg.svd(a, compute_uv=False)[:2])


def test_new_rows_and_unknown_features(spark):
    a = matrix(30, 12, 3)
    found = R.truncated_svd(cells(spark, a), 5)
    v = vectors(found, 12)
    new = np.zeros((3, 14))
    new[0, 2], new[1, 13], new[2, 0], new[2, 12] = 1.5, 9, -2, 4
    got = {r.id: r.z for r in found.project(cells(spark, new, [70, 71, 72])).collect()}
    assert set(got) == {70, 72} and np.allclose(got[70], new[0, :12] @ v) and np.allclose(got[72], new[2, :12] @ v)


def test_one_row_and_no_row(spark):
    one = R.truncated_svd(spark.createDataFrame([(5, 3, 2.0), (5, 9, -1.0)], "id long, idx int, value double"), 4)
    assert one.k == 1 and np.isclose(one.singular[0], 5**0.5)
    none = R.truncated_svd(spark.createDataFrame([], "id long, idx int, value double"), 4)
    assert none.k == 0


def test_factor_of_many_tasks(spark):
    rows = np.random.default_rng(4).normal(size=(500, 6))
    table = spark.createDataFrame([(r.tolist(),) for r in rows], "z array<double>").repartition(40)
    r = R.triangular_factor(table, "z", 6)
    assert np.allclose(r.T @ r, rows.T @ rows)


def test_too_many_components(spark):
    wide = spark.range(R.MAX_COMPONENTS + 20).selectExpr("id % 7 as id", "id as idx", "1D as value")
    with pytest.raises(ValueError):
        R.truncated_svd(wide, R.MAX_COMPONENTS + 1)
