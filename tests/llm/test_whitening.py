import math

import numpy as np
import pytest

from tessera.llm import whitening
from tessera.llm.whitening import Spectrum, rank_one, secular_roots

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long"


def whole(vector):
    return vector is not None and len(vector) > 0 and all(v is not None and math.isfinite(v) for v in vector)


def brute(rows, components=8):
    """{(vec_id, occurrence, component): (n, deviation, |whitened|, explained)} by a dense eigensolver."""
    out, lengths = [], {}
    for vec_id, v in rows:
        if whole(v):
            lengths.setdefault(len(v), []).append((vec_id, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]))
    for d, group in lengths.items():
        n = len(group)
        sums = [sum(x[k] for _, x in group) for k in range(d)]
        x = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for _, v in group])
        values, vectors = np.linalg.eigh(x.T @ x / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        for (vec_id, ints), row in zip(group, x):
            dev = sum((n * a - s) ** 2 for a, s in zip(ints, sums))
            for c in range(min(components, d)):
                flat = values[c] <= 1e-9 * max(values.sum(), 1e-300)
                out.append((vec_id, c + 1, n, dev, None if flat else abs(float(row @ vectors[:, c])) / math.sqrt(values[c]),
                            float(values[c] / values.sum()) if values.sum() > 0 else None))
    return out


def close(a, b, tol):
    return (a is None) == (b is None) and (a is None or abs(a - b) <= tol)


def check(spark, rows, parts=7, tol=1e-7):
    df = spark.createDataFrame([(k, v, 1, "x", 2) for k, v in rows], SCHEMA).repartition(parts)
    got = [tuple(r) for r in whitening.whiten(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], round(abs(r[4]), 4) if r[4] is not None else -1)
    expected = sorted(brute(rows), key=key)
    got = sorted(got, key=key)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:4] == e[:4]
        assert close(None if g[4] is None else abs(g[4]), e[4], tol) and close(g[5], e[5], 1e-9)
        assert g[6] is None or g[6] <= 1e-9
    return got


def test_against_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 12)) * np.linspace(3, 0.1, 12)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    rows += [(7, rows[7][1]), (None, rows[8][1])]                              # repeated row, null id
    rows += [(2000 + k, rows[9][1]) for k in range(300)]                       # a third are copies
    rows += [(5000, None), (5001, []), (5002, [1.0] * 11 + [None]), (5003, [1.0] * 11 + [float("nan")]), (5004, [1.0] * 11 + [float("inf")])]
    got = check(spark, rows, parts=40)                                         # three rounds of merging
    assert {r[0] for r in got}.isdisjoint({5000, 5001, 5002, 5003, 5004})


def test_degenerate_tables(spark):
    check(spark, [])
    assert all(r[4] is None and r[5] is None for r in check(spark, [(1, [1.0, 2.0, 3.0])]))
    rng = np.random.default_rng(4)
    flat = [(k, [float(a), float(2 * a), 1.0, float(b)]) for k, (a, b) in enumerate(rng.integers(-50, 50, size=(200, 2)))]
    got = check(spark, flat)                                                   # rank two of four
    assert {r[1] for r in got if r[4] is None} == {3, 4}
    check(spark, [(k, [float(k % 5), 0.5 * k]) for k in range(30)] + [(k, [1.0, float(k), 0.25 * (k % 3)]) for k in range(40)])


def test_large_entries_and_exact_sums(spark):
    df = spark.createDataFrame([(1, [1e9]), (2, [-1e9]), (3, [3e38]), (4, [0.5])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whitening.whiten(df).collect()}
    assert set(got) == {1, 2, 4} and got[1].deviation is None and got[4].n == 3
    x = np.array([[1 << 40, -(1 << 40)], [3, 5]])
    s = Spectrum(2)
    for _ in range(3):
        s.add(x)
    again = Spectrum.unpacked(2, s.packed())
    assert again.sums == [3 * ((1 << 40) + 3), 3 * (5 - (1 << 40))] and again.n == 6


@pytest.mark.parametrize("poles, weights", [
    ([0.0, 1.0, 2.0], [0.3, 0.2, 0.1]), ([1.0], [4.0]), ([0.0, 1e-9, 1.0], [1e-6, 1.0, 1e-12]), ([5.0, 6.0], [1e6, 1e-6]),
])
def test_secular_roots_interlace_and_solve(poles, weights):
    poles, weights = np.array(poles), np.array(weights)
    roots, gap = secular_roots(poles, weights)
    assert np.all(roots >= poles) and np.all(roots[:-1] <= poles[1:])
    exact = np.linalg.eigvalsh(np.diag(poles) + np.sqrt(np.outer(weights, weights)))
    assert np.allclose(roots, exact, rtol=1e-12, atol=1e-12 * exact[-1])
    assert np.allclose(gap, roots - poles[:, None], rtol=1e-6, atol=1e-12 * exact[-1])


def test_rank_one_updates_with_deflation():
    rng = np.random.default_rng(5)
    for case in range(40):
        d = int(rng.integers(1, 20))
        values = np.sort(rng.integers(0, 4, size=d).astype(float))             # many equal ones
        vectors = np.linalg.qr(rng.normal(size=(d, d)))[0]
        v = vectors @ (rng.normal(size=d) * rng.integers(0, 2, size=d))        # some without weight
        matrix = (vectors * values) @ vectors.T + 0.7 * np.outer(v, v)
        new, basis = rank_one(values, vectors, v, 0.7)
        assert np.allclose(new, np.linalg.eigvalsh(matrix), atol=1e-11)
        assert np.allclose(basis.T @ basis, np.eye(d), atol=1e-11)
        assert np.allclose((basis * new) @ basis.T, matrix, atol=1e-11)


def test_spectra_stay_exact_and_merge():
    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(size=(500, 16)) * 300 * np.linspace(1, 0.01, 16)).astype(np.int64) + 100000
    a, b = Spectrum(16), Spectrum(16)
    a.add(x[:180])
    b.add(x[180:])
    a.merge(b)
    centred = x - x.mean(axis=0)
    assert a.n == 500 and np.allclose(a.mean, x.mean(axis=0), rtol=1e-13)
    assert np.allclose(a.values, np.linalg.eigvalsh(centred.T @ centred), rtol=1e-9)
    assert np.abs(a.vectors.T @ a.vectors - np.eye(16)).max() < 1e-11
