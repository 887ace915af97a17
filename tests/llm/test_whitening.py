"""Whitening against numpy's own eigenvectors and exact sums."""

import math

import numpy as np
import pytest

from cohortry.llm import whitening


def test_eigen_solver():
    rng = np.random.default_rng(1)
    for d, rank in ((1, 1), (2, 2), (3, 3), (17, 17), (64, 64), (40, 7)):
        b = rng.standard_normal((rank, d)) * np.exp(rng.uniform(-2, 2, d))
        v = b.T @ b
        values, vectors = whitening.principal(v, 16)
        want = np.linalg.eigvalsh(v)[::-1][: min(16, rank)]
        assert len(values) == len(want)
        assert np.allclose(values, want, rtol=1e-12, atol=1e-12 * want[0])
        assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_equal_eigenvalues():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    for spectrum in (np.r_[np.full(5, 3.0), np.full(25, 1.0)], np.ones(30), np.r_[4.0, np.full(29, 4.0 - 1e-13)]):
        v = (q * spectrum) @ q.T
        values, vectors = whitening.principal((v + v.T) / 2, 16)
        assert np.allclose(values, np.sort(spectrum)[::-1][:16], atol=1e-12)
        assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13
        assert np.abs(v @ vectors - vectors * values).max() < 1e-12
    assert whitening.principal(np.eye(3), 16)[1].shape == (3, 3)
    assert whitening.principal(np.zeros((3, 3)), 16)[1].shape == (3, 0)
    assert whitening.principal(np.diag([0.0, 5.0, 0.0]), 16)[0].tolist() == pytest.approx([5.0])


def brute(rows, most=16):
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = {}
    for d in {len(x) for _, x in kept}:
        fit = sorted({tuple(x) for _, x in kept if len(x) == d})
        n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        y = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
        v = y.T @ y / n
        e, q = np.linalg.eigh(v)
        e, q = e[::-1][:most], q[:, ::-1][:, :most]
        for i, x in kept:
            if len(x) == d:
                whole = [n * c - s for c, s in zip(x, sums, strict=True)]
                for k in range(len(e)):
                    if e[k] > 1e-9 * e[0]:
                        out.setdefault(i, {})[k + 1] = (n, sum(w * w for w in whole), abs(float(np.array(whole) / n @ q[:, k]) / math.sqrt(e[k])), e[k] / np.trace(v))
    return out


def test_whiten_against_brute_force(spark):
    rng = np.random.default_rng(5)
    basis = rng.standard_normal((24, 24)) * np.linspace(3, 0.2, 24)
    rows = [(i, [float(c) for c in np.float32(rng.standard_normal(24) @ basis)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a hot group of copies
    rows += [(2000, None), (2001, []), (2002, [None] + [1.0] * 23), (2003, [float("nan")] * 24), (2004, [float("inf")] + [0.0] * 23), (2005, [0.0] * 24)]
    rows += [(3000 + i, [float(i), float(i * i), 1.0]) for i in range(5)]  # another length, one constant dimension
    got = {}
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<float>, x string, component int")
    errors = set()
    for r in whitening.whiten(df).collect():
        got.setdefault(r.vec_id, {})[r.component] = (r.n, r.deviation, abs(r.whitened), r.explained)
        errors.add(r.identity_error)
    want = brute([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    assert got.keys() == want.keys()
    for i, each in want.items():
        assert got[i].keys() == each.keys()
        for k, (n, deviation, white, explained) in each.items():
            assert got[i][k][:2] == (n, deviation)
            assert got[i][k][2] == pytest.approx(white, abs=1e-7)
            assert got[i][k][3] == pytest.approx(explained, rel=1e-9)
    assert max(errors) < 1e-9 and len(errors) == 2


def test_one_sign_for_all_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(80)]
    w = np.zeros((80, 8))
    for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)).collect():
        w[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(w.mean(axis=0)).max() < 1e-10
    assert np.abs(w.T @ w / 80 - np.eye(8)).max() < 1e-10


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], schema)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 2.0]), (None, [3.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in sorted(two, key=lambda r: r.vec_id or 0)] == [(None, 1, 2, 128 * 128), (None, 1, 2, 128 * 128), (1, 1, 2, 128 * 128)]


def test_wide_entries(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [5e11, 2.0])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert set(got) == {1, 2, 3} and got[1].deviation is None and got[1].identity_error < 1e-4
    rows = [(i, [1e300 * (-1) ** i, float(i)]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 9 and all(r.deviation is None and math.isfinite(r.whitened) for r in got)
