"""Components and whitened vectors against dense linear algebra."""

import math

import numpy as np
import pytest

from setwise.llm import eigen, whitening

SCHEMA = "vec_id long, embedding array<float>, id int, v string, component int, n int"


def whole(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100000 for c in vector]


def plain(vectors, k=8):
    """Exact sums and deviations, and the dense eigenvectors."""
    x = [whole(v) for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    scaled = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    c = np.array(scaled, dtype=np.float64) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, [sum(s * s for s in r) for r in scaled], c @ axes / np.sqrt(values), values / (c * c).sum() * n


def frame(spark, vectors):
    rows = [(i, v, 7, "x", 1, 2) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("block", [4 << 20, 400])
def test_whitened_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", block)
    dice = np.random.default_rng(3)
    good = (dice.standard_normal((300, 12)) * np.linspace(0.2, 3, 12) + dice.standard_normal(12)).astype(np.float32)
    rows = list(enumerate(good.tolist()))
    rows += [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, []), (905, [1.0, 2.0])]
    rows += [(None, rows[3][1]), (4, rows[4][1]), (4, rows[5][1])]
    found = whitening.whiten(frame(spark, rows)).collect()
    used = rows[:300] + rows[306:]
    n, deviations, whitened, explained = plain([v for _, v in used])
    assert len(found) == 8 * len(used) and {r["n"] for r in found} == {n}
    want = {}
    for (i, _), deviation, z in zip(used, deviations, whitened):
        want.setdefault(i, []).append((deviation, z))
    signs = {}
    for r in found:
        j = r["component"] - 1
        assert abs(r["explained"] / explained[j] - 1) < 1e-9 and r["identity_error"] < 1e-9
        fitting = [z[j] for deviation, z in want[r["vec_id"]] if deviation == int(r["deviation"])]
        sign = signs.setdefault(j, 1 if any(abs(z - r["whitened"]) < 1e-9 for z in fitting) else -1)
        assert any(abs(sign * z - r["whitened"]) < 1e-8 for z in fitting)


def test_large_numbers_stay_exact(spark):
    dice = np.random.default_rng(5)
    vectors = (dice.standard_normal((50, 3)) * 1e9).astype(np.float32).tolist()
    found = whitening.whiten(frame(spark, list(enumerate(vectors)))).collect()
    limited = [[min(max(c, -(2.0**32)), 2.0**32) for c in v] for v in vectors]
    _, deviations, _, _ = plain(limited)
    assert {(r["vec_id"], int(r["deviation"])) for r in found} == set(enumerate(deviations))
    assert len(found) == 150


def test_cases(spark):
    assert whitening.whiten(frame(spark, []).limit(0)).isEmpty()
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).isEmpty()
    assert whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).isEmpty()
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-9
    out = whitening.whiten(frame(spark, [(i, [float(i), float(i % 3)]) for i in range(9)]))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize(
    "matrix",
    [
        np.zeros((5, 5)), np.eye(20), np.diag([3, 3, 3, 1, 1, 0, 0, 0, 0, 0.0]), np.outer(np.arange(9.0), np.arange(9.0)),
        np.zeros((1, 1)), np.diag(1 + 1e-9 * np.arange(30)), np.diag(2.0 ** -np.arange(40)), np.diag(np.linspace(1, 2, 200) ** 3),
    ],
)
def test_leading_vectors(matrix):
    values, axes = eigen.leading(lambda t: matrix @ t, len(matrix), 8)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:8], atol=1e-12 * max(1, values[0]))
    assert np.abs(axes.T @ axes - np.eye(axes.shape[1])).max() < 1e-13
    assert np.abs(matrix @ axes - axes * values).max() <= 1e-13 * max(1, values[0])


def test_columns_are_solved_in_lockstep():
    dice = np.random.default_rng(1)
    a = dice.standard_normal((15, 15))
    a = a + a.T
    right = np.c_[dice.standard_normal((15, 3)), np.zeros(15)]
    x = eigen.minres(lambda t: a @ t, right, 40, 1e-13)
    assert np.abs(a @ x - right).max() < 1e-9
