import math

import numpy as np
import pytest

from salescast.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "n") for i, v in rows], SCHEMA)


def whole(vectors):
    return np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(np.int64) + 100_000


def check(got, ids, x, components=8):
    """Against the eigenvalues and vectors of the covariance written out."""
    n, k = len(x), min(components, x.shape[1])
    centred = x - np.array([int(s) / n for s in x.sum(axis=0)])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    want = centred @ vectors / np.sqrt(values)
    rows = sorted(got, key=lambda r: (r.component, r.vec_id))
    found = np.array([r.whitened for r in rows]).reshape(k, n).T
    assert [(r.component, r.vec_id) for r in rows] == [(j + 1, i) for j in range(k) for i in sorted(ids)]
    want = want[np.argsort(ids)]
    signs = np.sign((found * want).sum(axis=0))
    assert np.abs(found - want * signs).max() < 1e-8
    deviation = [int(v) for v in ((n * x.astype(object) - x.sum(axis=0)) ** 2).sum(axis=1)[np.argsort(ids)]]
    assert [r.deviation for r in rows] == deviation * k
    assert {r.n for r in rows} == {n}
    for r in rows:
        assert math.isclose(r.explained, values[r.component - 1] / (centred ** 2).sum() * n, rel_tol=1e-9)
    (error,) = {r.identity_error for r in rows}
    assert error < 1e-9


def test_equals_dense_decomposition(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((400, 20)) * np.linspace(2, 0.2, 20)).astype(np.float32)
    ids = rng.permutation(400).tolist()
    check(w.whiten(table(spark, list(zip(ids, vectors.tolist())))).collect(), ids, whole(vectors))


def test_fewer_dimensions_than_components(spark):
    vectors = np.random.default_rng(2).standard_normal((30, 3)).astype(np.float32)
    check(w.whiten(table(spark, list(enumerate(vectors.tolist())))).collect(), list(range(30)), whole(vectors))


def test_unusable_vectors_are_left_out(spark):
    vectors = np.random.default_rng(3).standard_normal((20, 4)).astype(np.float32).tolist()
    rows = list(enumerate(vectors)) + [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [math.nan, 1.0, 2.0, 3.0]), (103, []),
                                       (104, [math.inf, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0, 0.0])]
    check(w.whiten(table(spark, rows)).collect(), list(range(20)), whole(vectors))


def test_ties_repeated_rows_and_directions_without_variance(spark):
    rows = [(1, [0.0, 0.0, 5.0])] * 2 + [(None, [1.0, 0.0, 5.0]), (3, [0.0, 1.0, 5.0]), (3, [1.0, 1.0, 5.0]), (4, [1.0, 1.0, 5.0])]
    got = w.whiten(table(spark, rows)).collect()
    assert len(got) == 18 and all((r.whitened is None) == (r.component == 3) for r in got)
    assert {r.explained for r in got if r.component == 3} == {0.0} and {r.n for r in got} == {6}
    assert got[0].identity_error < 1e-9
    (a, b) = [r.whitened for r in got if r.vec_id == 1 and r.component == 1]
    assert a == b


@pytest.mark.parametrize("rows", [[(1, [0.5, 0.25])], [(1, [0.5, 0.25])] * 3])
def test_no_variance_at_all(spark, rows):
    got = w.whiten(table(spark, rows)).collect()
    assert len(got) == 2 * len(rows) and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, None, None, 0.0)}


def test_no_vectors(spark):
    assert w.whiten(table(spark, [])).count() == 0
    got = w.whiten(table(spark, [(1, None), (2, [])]))
    assert got.columns == "vec_id component n deviation whitened explained identity_error".split() and got.count() == 0


def test_deviation_beyond_64_bits_is_null(spark):
    got = w.whiten(table(spark, [(1, [3e15]), (2, [-3e15]), (3, [0.0])])).collect()
    assert [r.deviation for r in sorted(got, key=lambda r: r.vec_id)] == [None, None, 0]


@pytest.mark.parametrize("kind", ["flat", "decaying", "multiple", "of low rank"])
@pytest.mark.parametrize("d", [1, 7, 8, 60, 200])
def test_solver_reaches_rounding(d, kind):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"flat": 1 + np.arange(d) / d, "decaying": 0.9 ** np.arange(d), "multiple": np.repeat([5.0, 3.0, 1.0], [4, 3, d])[:d],
              "of low rank": np.arange(d) < 3}[kind].astype(float)
    a = q * values @ q.T
    found, vectors, residuals = w.jacobi_davidson(lambda u: a @ u, d, 8)
    assert np.abs(found - np.sort(values)[::-1][:8]).max() < 1e-12 * values.max()
    assert residuals.max() < 1e-11 * values.max() and np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12


def test_minres_takes_the_least_residual_of_the_krylov_space():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((30, 30))
    a, b = a + a.T, rng.standard_normal((30, 4))
    for steps in (1, 4, 9):
        got = np.linalg.norm(a @ w._minres(lambda v: a @ v, b, steps) - b, axis=0)
        for j in range(4):
            space = [b[:, j]]
            for _ in range(steps - 1):
                space.append(a @ space[-1] / np.linalg.norm(a @ space[-1]))
            q = np.linalg.qr(np.array(space).T)[0]
            best = np.linalg.norm(a @ q @ np.linalg.lstsq(a @ q, b[:, j], rcond=None)[0] - b[:, j])
            assert got[j] == pytest.approx(best, rel=1e-6)
