"""Jacobi-Davidson and whitening against plain linear algebra."""

import numpy as np
import pytest

from indicata.llm import whitening as w


def brute(rows, components=16):
    """[(vec_id, deviation, whitened...)], explained, n, from an eigendecomposition of the formed matrix."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(e is not None and np.isfinite(e) for e in v)]
    x = np.array([[int(np.floor(64 * float(e))) + 1_000_000 for e in v] for _, v in good], dtype=object)
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    top = x * n - sums
    deviations = [int(v) for v in (top * top).sum(axis=1)]
    c = (fit * n - sums).astype(float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    real = e > 1e-12 * max(e[0], 1e-300)
    z = (top.astype(float) / n) @ u[:, real] / np.sqrt(e[real])
    return [i for i, _ in good], deviations, z, e[real] / np.einsum("ij,ij->", c, c) * n, n


def agrees(got, rows):
    ids, deviations, z, explained, n = brute(rows)
    k = z.shape[1]
    assert len(got) == len(ids) * k
    have = {}
    for r in got:
        have.setdefault((r.vec_id, r.component), []).append(r)
    for j in range(k):
        mine = np.array([have[i, j + 1][0].whitened for i in ids])
        sign = np.sign(mine @ z[:, j])
        assert np.abs(mine - sign * z[:, j]).max() < 1e-9
    for i, d in zip(ids, deviations):
        for r in have[i, 1]:
            assert r.deviation == (d if d < 2 ** 63 else None) and r.n == n
    for r in got:
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10 and r.identity_error < 1e-9
        assert r.residual <= 1e-12 * got[0].eigenvalue * len(z) or r.residual < 1e-9


@pytest.mark.parametrize("d", [1, 2, 5, 16, 17, 24, 40, 150])
@pytest.mark.parametrize("kind", ["lin", "geo", "pairs", "equal", "zero", "few"])
def test_eigenpairs(d, kind):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = {"lin": np.arange(1.0, d + 1), "geo": 1.4 ** -np.arange(d), "pairs": np.repeat(np.arange(1.0, d + 1), 2)[:d],
         "equal": np.full(d, 3.0), "zero": np.zeros(d), "few": np.where(np.arange(d) < 3, 5.0 + np.arange(d), 0)}[kind]
    a = q * e @ q.T
    a = (a + a.T) / 2
    got = w.jacobi_davidson(lambda x: a @ x, d, 16)
    k = min(16, d)
    assert np.allclose(got.values, np.sort(e)[::-1][:k], rtol=0, atol=1e-12 * max(1, e.max()))
    assert np.abs(got.vectors.T @ got.vectors - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(a @ got.vectors - got.vectors * got.values, axis=0).max() <= 1e-12 * max(1, e.max())
    assert d < 150 or got.products < 200


def test_minres_solves_the_projected_equations():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    fixed = np.linalg.qr(rng.standard_normal((30, 4)))[0]
    p = np.eye(30) - fixed @ fixed.T
    b = p @ rng.standard_normal((30, 3))
    shifts = np.array([1.0, -2.5, 40.0])
    t = w.minres(lambda x: a @ x, b, shifts, fixed, 40)
    for j in range(3):
        assert np.abs(p @ (a @ t[:, j] - shifts[j] * t[:, j]) - b[:, j]).max() < 1e-8
        assert np.abs(fixed.T @ t[:, j]).max() < 1e-10
    assert not w.minres(lambda x: a @ x, np.zeros((30, 2)), shifts[:2], fixed, 5).any()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, x string, component int")


def test_brute_force_and_defined_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.standard_normal(20) * np.arange(1, 21)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a third are copies
    odd = [(2000, None), (2001, [None] + [0.0] * 19), (2002, [float("nan")] * 20), (2003, [float("inf")] * 20),
           (2004, [1.0]), (2005, []), (2006, [1e300] * 20)]
    agrees(w.whiten(frame(spark, rows + odd)).collect(), rows)
    twice = w.whiten(frame(spark, rows + rows[:2] + [(None, rows[1][1])])).collect()
    assert len(twice) == (len(rows) + 3) * 16
    assert {(r.whitened, r.deviation) for r in twice if r.vec_id is None} == {(r.whitened, r.deviation) for r in twice if r.vec_id == 1}


def test_few_distinct_vectors(spark):
    flat = [(i, [0.5, 0.25, -1.0]) for i in range(5)]
    assert w.whiten(frame(spark, flat)).collect() == [] and w.whiten(frame(spark, [])).collect() == []
    assert w.whiten(frame(spark, [(1, []), (2, None)])).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(4)]
    got = w.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)
    agrees(got, line)


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2 ** 50 + i), float((i * 7919) % 13) * 2.0 ** 45]) for i in range(40)]
    got = w.whiten(frame(spark, rows)).collect()
    ids, deviations, *_ = brute(rows)
    want = dict(zip(ids, deviations))
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 2 ** 63 else None) for r in got)
