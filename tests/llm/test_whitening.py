import math
from fractions import Fraction

import numpy as np
import pytest

from almsbook.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, x string, dim string, n int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "a", "b", 1) for i, v in rows], SCHEMA.replace("float", kind))


def plain(rows):
    """Fit list, whole sums and covariance by fractions; rows that take part."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, total = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = [[Fraction(c) - Fraction(s, n) for c, s in zip(x, total, strict=True)] for x in fit]
    d = len(total)
    covariance = np.array([[float(sum(y[i] * y[j] for y in centred) / n) for j in range(d)] for i in range(d)])
    return kept, n, total, covariance


def sample(seed, count, dim, scale=1.0):
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(dim, dim)) * np.linspace(0.1, 2, dim)
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(count, dim)) @ mixing * scale + rng.normal(size=dim) * 3)]


EXTRA = [(900, None), (901, [1.0, None, 2.0, 0.0]), (902, [float("nan"), 0.0, 0.0, 0.0]), (903, [float("inf"), 0.0, 0.0, 0.0]), (903, [float("-inf"), 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("scale", [1.0, 50.0])
def test_against_fractions(spark, scale):
    rows = sample(1, 80, 4, scale)
    rows += rows[:10] + [(None, rows[0][1]), (77, rows[3][1])] + [(1000 + i, rows[5][1]) for i in range(300)]
    kept, n, total, covariance = plain(rows + EXTRA)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = wh.digest(frame(spark, rows + EXTRA))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    out = found.collect()
    assert len(out) == len(kept) * 4 and len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-12
    wanted = {}
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, total, strict=True))
        projected = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, total, strict=True)]) @ vectors / np.sqrt(values)
        for k in range(4):
            wanted.setdefault((i, k + 1), []).append((deviation, projected[k]))
    signs = {}
    for r in out:
        assert r["n"] == n and r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-12)
        choices = wanted[r["vec_id"], r["component"]]
        match = [p for d, p in choices if d == r["deviation"]]
        assert match and any(abs(abs(p) - abs(r["whitened"])) < 1e-9 for p in match)
        if abs(match[0]) > 1e-6 and len(choices) == 1:
            signs.setdefault(r["component"], set()).add(np.sign(match[0]) == np.sign(r["whitened"]))
    assert all(len(s) == 1 for s in signs.values())


def test_sixteen_components_of_many(spark):
    rows = sample(2, 200, 24)
    out = wh.digest(frame(spark, rows)).collect()
    assert sorted({r["component"] for r in out}) == list(range(1, 17)) and len(out) == 3200
    _, _, _, covariance = plain(rows)
    share = np.sort(np.linalg.eigvalsh(covariance))[::-1] / np.trace(covariance)
    assert {r["component"]: pytest.approx(r["explained"], rel=1e-9) for r in out} == {k + 1: share[k] for k in range(16)}


@pytest.mark.parametrize("values", [
    np.random.default_rng(0).random(40), [1, 1, 1, 0.5, 0.5, 1e-3, 1e-3 + 1e-9, 0.25, 0.25 + 1e-10, 0.25 + 2e-10], [1 + 1e-12 * i for i in range(12)], [1] * 6 + [1e-6] * 6,
    10.0 ** -np.arange(12), [1, 0, 0, 0], [0, 0], [3],
])
def test_eigenvectors_beyond_double_precision(values):
    """Residuals and orthogonality far below what float32 or float64 give, clusters included."""
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(d) - 0.5 * q.T @ q)
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    found, x = wh.refined_eigen(a)
    assert np.all(np.diff(found) <= 0) and np.abs(found - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-17 * d * max(1, max(values))
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17 * d and np.abs(a @ x - x * found).max() < 5e-16


def test_exact_sums_of_large_numbers():
    rng = np.random.default_rng(3)
    for top in (100, 1 << 20, 1 << 27, 1 << 53):
        x = rng.integers(-top, top, size=(300, 3), endpoint=True)
        assert wh.exact_sum(x).tolist() == [sum(int(v) for v in column) for column in x.T]
        assert wh.exact_products(x).tolist() == [[sum(int(a) * int(b) for a, b in zip(p, q, strict=True)) for q in x.T] for p in x.T]


def test_lengths_are_populations_and_odd_rows(spark):
    rows = sample(4, 30, 2) + [(100 + i, v) for i, v in sample(5, 40, 3)] + [(500, []), (501, [4.0] * 7), (502, [4.0] * 7)]
    out = wh.whiten(frame(spark, rows)).collect()
    assert {(r["dim"], r["n"]) for r in out} == {(2, 30), (3, 40)} and len(out) == 30 * 2 + 40 * 3
    alone = {(r["vec_id"], r["component"]): r["whitened"] for r in wh.whiten(frame(spark, rows[:30])).collect()}
    assert {(r["vec_id"], r["component"]): pytest.approx(r["whitened"], rel=1e-12) for r in out if r["dim"] == 2} == alone


def test_flat_directions_have_no_component(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    assert {r["component"] for r in wh.digest(frame(spark, rows)).collect()} == {1}


def test_huge_entries(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, -1e200]), (4, [5.0, 5.0])]
    out = wh.digest(frame(spark, rows, "double")).collect()
    assert len(out) == 8 and all(math.isfinite(r["whitened"]) for r in out) and all(r["deviation"] is None for r in out)


def test_empty_table(spark):
    assert wh.digest(frame(spark, [])).collect() == [] and wh.digest(frame(spark, EXTRA)).collect() == []
