"""Whitening against numpy's eigenvectors, and exact deviations."""

import math

import numpy as np
import pytest

from stoplines.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string"


def vectors(n=300, size=20, seed=1):
    rng = np.random.default_rng(seed)
    spread = 0.9 ** np.arange(size)
    return (rng.standard_normal((n, size)) * spread @ np.linalg.qr(rng.standard_normal((size, size)))[0]).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)


def expected(rows, count=8):
    """n, deviations by row, whitened up to sign, explained."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = (n * np.array(x) - np.array(sums)) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:count], turn[:, ::-1][:, :count]
    return n, deviations, centred @ turn / np.sqrt(values), values / (centred**2).sum() * n


def check(spark, rows, df, count=8, tolerance=1e-9):
    n, deviations, whitened, explained = expected(rows, count)
    got = whitening.whiten(df, count).collect()
    assert len(got) == n * count
    own = {}
    for row in got:
        assert row.n == n and row.identity_error < 1e-9
        assert row.explained == pytest.approx(explained[row.component - 1], rel=1e-9)
        own.setdefault(row.component, []).append((row.vec_id, int(row.deviation), row.whitened))
    for component, found in own.items():
        y = whitened[:, component - 1]
        least = min(
            max(abs(a[2] - b[2]) for a, b in zip(sorted(found), sorted(zip([i for i, _ in rows], deviations, sign * y, strict=True)), strict=True))
            for sign in (1, -1)
        )
        assert least < tolerance
        assert sorted(d for _, d, _ in found) == sorted(deviations)
    return got


def test_equals_numpy(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors())]
    check(spark, rows, frame(spark, rows))


def test_unusable_vectors_are_left_out(spark):
    good = [(i, v.tolist()) for i, v in enumerate(vectors(60, 10))]
    bad = [(100, None), (101, []), (102, [None] * 10), (103, [float("nan")] * 10), (104, [1.0] * 9 + [float("-inf")]), (105, [0.5] * 4)]
    check(spark, good, frame(spark, good + bad), 5)


def test_repeated_and_null_ids(spark):
    rows = [(i // 2, v.tolist()) for i, v in enumerate(vectors(40, 6))]
    rows += [rows[0], rows[0]]
    n, deviations, _, _ = expected(rows, 3)
    got = whitening.whiten(frame(spark, rows + [(None, rows[5][1])]), 3).collect()
    assert len(got) == 3 * (n + 1)
    assert len({(row.component, row.whitened) for row in got if row.vec_id == 0}) == 2 * 3
    assert len([row for row in got if row.vec_id is None]) == 3


def test_few_dimensions_and_low_rank(spark):
    flat = [(i, [float(i % 7), 2.0 * (i % 7), 3.0, 0.0]) for i in range(30)]
    got = whitening.whiten(frame(spark, flat)).collect()
    assert {row.component for row in got} == {1} and got[0].explained == pytest.approx(1.0)
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5]), (2, [0.5])]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whiten(frame(spark, rows))
    assert found.count() == 0
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_a_long():
    model = whitening.Whitening(10**6, np.array([0, 5]), 1.0, np.ones(1), np.ones((2, 1)), 0.0)
    assert model.deviation(np.array([[10**5, -(10**5)], [1, 1]])) == [10**22 + (10**11 + 5) ** 2, 10**12 + (10**6 - 5) ** 2]


def test_eigenpairs_of_close_values():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((50, 50)))[0]
    values = np.sort(np.concatenate([[1, 1 - 1e-5, 0.9], np.linspace(0.8, 0.0, 47)]))[::-1]
    v = turn * values @ turn.T
    passes = []
    got, pairs, residual = whitening.eigenpairs(lambda q: passes.append(1) or v @ q, 50, 4)
    assert residual < 1e-12 and len(passes) < 80
    assert np.allclose(got, values[:4], rtol=1e-12)
    assert np.allclose(np.abs(pairs.T @ turn[:, :4]), np.eye(4), atol=1e-6)
    whole = whitening.eigenpairs(lambda q: v @ q, 50, 50)
    assert np.allclose(whole[0], values, atol=1e-12)
