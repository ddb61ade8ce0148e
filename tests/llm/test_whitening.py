"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from lakeload.llm import whitening
from lakeload.llm.whitening import leading, whiten


@pytest.fixture
def table(spark):
    def make(vectors, kind="float", ids=None):
        ids = ids or range(len(vectors))
        rows = [(i, v, "x", 1) for i, v in zip(ids, vectors, strict=True)]
        return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, n string, component int")

    return make


def plain(vectors, kind=np.float32, components=4):
    """n, S, and what each vector should give, signs of components aside."""
    x = np.array([[int(np.floor(float(kind(c)) * 256)) for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    trace = np.square(centred).sum() / n
    deviations = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return n, deviations, (x - sums / n) @ turn / np.sqrt(values), values / trace


def check(found, vectors, components=4, **kw):
    n, deviations, whitened, explained = plain(vectors, components=components, **kw)
    rows = {}
    for row in found.collect():
        rows.setdefault(row.vec_id, {})[row.component] = row
    assert len(rows) == len(vectors)
    ours = np.array([[rows[i][k + 1].whitened for k in range(components)] for i in range(len(vectors))])
    signs = np.sign((ours * whitened).sum(axis=0))
    assert np.abs(ours * signs - whitened).max() < 1e-8
    for i, row in rows.items():
        assert sorted(row) == list(range(1, components + 1))
        assert {r.n for r in row.values()} == {n} and {r.deviation for r in row.values()} == {deviations[i]}
        assert all(abs(r.explained / explained[k - 1] - 1) < 1e-10 for k, r in row.items())
        assert all(r.identity_error < 1e-9 for r in row.values())


def test_against_a_dense_decomposition(table):
    chance = np.random.default_rng(1)
    vectors = chance.normal(size=(700, 40)) * np.linspace(1, 2, 40)
    vectors = [*vectors.tolist(), *[vectors[3].tolist()] * 300]  # a third of the rows are copies
    found = whiten(table(vectors).repartition(5))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found, vectors)


def test_vectors_no_wider_than_the_iteration(table):
    vectors = np.random.default_rng(2).normal(size=(90, 6)).tolist()
    check(whiten(table(vectors)), vectors)
    check(whiten(table(vectors), components=2), vectors, components=2)


def test_doubles_of_very_different_size(table):
    chance = np.random.default_rng(3)
    vectors = (chance.normal(size=(200, 5)) * [1e-1, 1, 1e1, 1e2, 1e4]).tolist()
    found = whiten(table(vectors, "double")).collect()
    n, deviations, _, explained = plain(vectors, np.float64)
    for row in found:
        assert row.n == n
        assert row.deviation == (deviations[row.vec_id] if deviations[row.vec_id] < 2**63 else None)
        assert row.explained == pytest.approx(explained[row.component - 1], rel=1e-6)
        assert row.identity_error < 1e-4


def test_unusable_rows_go(table):
    chance = np.random.default_rng(4)
    good = chance.normal(size=(60, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 1.0, 1.0], [1.0], [-0.0] * 9]
    found = whiten(table(good + bad), components=3)
    check(found, good, components=3)


def test_huge_entries_stay_whole(table):
    rows = whiten(table([[1e300, 1.0], [-1e300, 2.0], [0.0, 3.0]], "double")).collect()
    assert len(rows) == 6 and all(r.deviation is None for r in rows if r.vec_id < 2)
    assert {r.n for r in rows} == {3}


def test_no_variance_is_null(table):
    rows = whiten(table([[1.0, 2.0]] * 3), components=4).collect()
    assert len(rows) == 6 and {r.n for r in rows} == {1} and {r.deviation for r in rows} == {0}
    assert {(r.whitened, r.explained, r.identity_error) for r in rows} == {(None, None, None)}
    rows = whiten(table([[0.0, 2.0], [1.0, 2.0], [5.0, 2.0]])).collect()
    assert {r.component: r.whitened is None for r in rows} == {1: False, 2: True}
    assert {r.explained for r in rows} == {1.0, 0.0}


def test_nothing(table):
    for vectors in ([], [None], [[]], [[float("nan")]]):
        found = whiten(table(vectors))
        assert found.count() == 0 and len(found.columns) == 7


def test_ids_may_be_null_or_repeat(table):
    rows = whiten(table([[1.0, 0.0], [0.0, 1.0], [3.0, 1.0]], ids=[None, 7, 7]), components=1).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in rows) == [(False, 7), (False, 7), (True, 0)]


class Known:
    def __init__(self, matrix):
        self.matrix, self.dimensions, self.passes = matrix, len(matrix), 0

    def __matmul__(self, q):
        self.passes += 1
        return self.matrix @ q


@pytest.mark.parametrize("seed", range(6))
def test_iteration_on_many_spectra(seed):
    chance = np.random.default_rng(seed)
    size = 150
    spectrum = [
        np.linspace(1, 2, size),
        1 / np.arange(1, size + 1) ** 2,
        np.ones(size),
        np.r_[np.full(size - 3, 1e-12), 5, 5, 7],
        np.r_[np.zeros(size // 2), np.linspace(0.99, 1, size - size // 2)],
        np.exp(chance.normal(size=size) * 4),
    ][seed]
    turn = np.linalg.qr(chance.normal(size=(size, size)))[0]
    matrix = Known((turn * spectrum) @ turn.T)
    values, vectors = leading(matrix, 4)
    wanted = np.sort(spectrum)[::-1][:4]
    assert np.abs(values - wanted).max() <= 1e-11 * wanted[0]
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12
    assert np.abs(matrix.matrix @ vectors - vectors * values).max() <= 1e-12 * wanted[0]
    assert matrix.passes < 8 * whitening.PATIENCE * 3


def test_filter_saves_passes_over_plain_iteration():
    size = 200
    matrix = Known(np.diag(np.linspace(0.5, 1, size) ** 2))
    leading(matrix, 4)
    assert matrix.passes < 120  # without it some 1,000: 0.865 to the power of passes
