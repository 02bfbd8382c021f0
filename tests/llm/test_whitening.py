"""Whitening against numpy's own eigenvectors, and its parts."""

import numpy as np
import pytest

from tidegate.llm import whitening


def frame(spark, rows, dtype="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {dtype}, vector string, component int")


def model(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    cov = centred.T @ centred / n
    values, found = np.linalg.eigh(cov)
    values, found = values[::-1][:k], found[:, ::-1][:, :k]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, total)) for row in x]
    return n, deviation, centred @ found / np.sqrt(values), values / np.trace(cov)


@pytest.mark.parametrize("size", [1, 2, 3, 8, 40])
def test_eigen(size):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(size, size))
    for matrix in (a @ a.T, np.eye(size), np.diag(np.arange(size) // 2 * 1.0), np.ones((size, size))):
        diagonal, beside, _ = whitening.tridiagonal(matrix)
        expected = np.linalg.eigvalsh(matrix)[::-1]
        for point in (*(expected + 1e-6), *(expected - 1e-6)):
            assert whitening.below(diagonal, beside, point) == (expected < point).sum()
        values, vectors = whitening.leading_components(matrix, 8)
        k = min(8, size)
        scale = max(1.0, abs(expected).max())
        assert np.allclose(values, expected[:k], atol=1e-13 * scale * size)
        assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-12)
        assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=2e-13 * scale * size)


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(vectors)]
    bad = [(900, None, "x", 1), (901, [None] * 12, "x", 1), (902, [float("nan")] * 12, "x", 1), (903, [float("-inf")] * 12, "x", 1)]
    found = whitening.whiten(frame(spark, rows + bad).repartition(5)).collect()
    n, deviation, whitened, explained = model(vectors)
    assert len(found) == 300 * 8 and {r.n for r in found} == {n}
    assert all(r.deviation == deviation[r.vec_id] for r in found)
    signs = {}
    for r in found:
        want = whitened[r.vec_id, r.component - 1]
        sign = signs.setdefault(r.component, np.sign(want * r.whitened))
        assert abs(sign * r.whitened - want) < 1e-8
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_awkward_rows(spark):
    same = frame(spark, [(1, [0.5, -0.25], "x", 1), (1, [0.5, -0.25], "x", 1), (None, [0.5, -0.25], "x", 1)])
    found = whitening.whiten(same).collect()
    assert len(found) == 6 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(0, None, 0.0, 0.0)}
    ragged = whitening.whiten(frame(spark, [(1, [1.0], "x", 1), (2, [1.0, 1.0], "x", 1), (3, [], "x", 1)])).collect()
    assert len(ragged) == 6 and max(r.identity_error for r in ragged) < 1e-9
    flat = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i], "x", 1) for i in range(5)])).collect()
    assert {r.component for r in flat if r.whitened is not None} == {1} and max(r.identity_error for r in flat) < 1e-9
    for none in ([], [(1, None, "x", 1)], [(1, [], "x", 1)]):
        assert whitening.whiten(frame(spark, none)).collect() == []


def test_long_deviation(spark):
    found = whitening.whiten(frame(spark, [(1, [1e15], "x", 1), (2, [-1e15], "x", 1)], "array<double>")).collect()
    assert [r.deviation for r in found] == [None, None]
