import math

import numpy as np
import pytest

from tillwise.llm import whitening

KIND = "vec_id long, embedding array<double>, x string, component string, n string, size string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], *"abcd") for i, v in rows], KIND)


def expected(vectors, most=4):
    """Distinct rows, whitened rows and explained shares by a plain eigendecomposition."""
    x = np.floor(np.array(vectors, np.float64) * 256)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(fit))
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    return fit, (x - fit.mean(axis=0)) @ directions / np.sqrt(values), values / (centred**2).sum() * len(fit), x


def check(found, vectors, most=4):
    fit, white, explained, x = expected(vectors, most)
    assert len(found) == len(vectors) * most
    by_row = {(r.vec_id, r.component): r for r in found}
    for k in range(most):
        own = np.array([by_row[i, k + 1].whitened for i in range(len(vectors))])
        big = int(np.abs(own).argmax())
        assert np.allclose(own * np.sign(own[big]), white[:, k] * np.sign(white[big, k]), atol=1e-7)
        assert math.isclose(by_row[0, k + 1].explained, explained[k], rel_tol=1e-6)
    exact = [sum((len(fit) * int(a) - int(s)) ** 2 for a, s in zip(row, fit.sum(axis=0), strict=True)) for row in x]
    assert [by_row[i, 1].deviation for i in range(len(vectors))] == exact
    assert {r.n for r in found} == {len(fit)} and all(r.identity_error < 1e-8 for r in found)


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(300, 8)) * np.array([9, 5, 3, 2, 1, 0.5, 0.1, 0.05]) + np.arange(8)
    vectors = np.concatenate([vectors, vectors[:120], vectors[:1].repeat(200, axis=0)])
    check(whitening.whitened(table(spark, list(enumerate(vectors.tolist())))).collect(), vectors)


def test_dependent_constant_and_unequal_columns(spark):
    """Columns that depend on others, never vary or are a millionth as wide do no harm."""
    rng = np.random.default_rng(3)
    base = np.floor(rng.normal(size=(200, 4)) * np.array([1e6, 1e3, 50, 8])) * 2
    vectors = np.column_stack([base, base[:, 0] + base[:, 1], base[:, 1] - base[:, 3], np.full(200, 7.0), np.zeros(200)]) / 256
    check(whitening.whitened(table(spark, list(enumerate(vectors.tolist())))).collect(), vectors)


def test_fewer_vectors_than_columns(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3, 10)) * 4
    check(whitening.whitened(table(spark, list(enumerate(vectors.tolist())))).collect(), vectors, most=2)


def test_qr_of_the_rows():
    """Solving for a factor is multiplying by its inverse; shifted factors exist for singular matrices."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(50, 6))
    factor = whitening._cholesky(rows.T @ rows, 50, shifted=True)
    assert np.allclose(whitening.solved(rows, factor) @ factor, rows) and np.allclose(factor, np.triu(factor))
    assert np.isfinite(whitening._cholesky(np.ones((6, 6)), 50, shifted=False)).all()


@pytest.mark.parametrize("scale", [1, 2**40])
def test_whole_numbers_beyond_a_long(spark, scale):
    vectors = np.array([[1, 2], [3, 5], [-4, 0], [8, 8]], np.float64) * scale / 256
    found = whitening.whitened(table(spark, list(enumerate(vectors.tolist())))).collect()
    exact = [sum((4 * a - s) ** 2 for a, s in zip(row, (8 * scale, 15 * scale), strict=True)) for row in (vectors * 256).astype(int).tolist()]
    assert {r.vec_id: r.deviation for r in found} == {i: e if e < 2**63 else None for i, e in enumerate(exact)}


def test_odd_rows(spark):
    rows = [(1, [1, 2]), (1, [1, 2]), (2, [3, -0.0]), (3, None), (4, []), (5, [1, None]), (6, [float("nan"), 1]), (7, [float("inf"), 1])]
    rows += [(8, [1e300, 0]), (9, [1, 2, 3]), (None, [5, 9]), (10, [3, 0.0])]
    found = whitening.whitened(table(spark, rows)).collect()
    assert sorted(str(r.vec_id) for r in found) == sorted(str(i) for i in (1, 1, 2, None, 10) for _ in range(2))
    assert {r.n for r in found} == {3}
    assert found[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, [1, 2]), (2, [1, 2])])).count() == 0
