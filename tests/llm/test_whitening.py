from __future__ import annotations

import math

import numpy as np
import pytest

from trafficlens.llm import whitening as wh


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows], f"vec_id long, embedding array<{kind}>")


def exact(rows):
    """Whole numbers, deviations, covariance, eigenvalues and vectors by a dense solver."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    far = ((n * x - s) ** 2).sum(axis=1)
    c = ((n * x - s) / n).astype(np.float64)
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    return c, far, v, e[::-1], u[:, ::-1]


def compare(got, rows, k):
    c, far, v, e, u = exact(rows)
    by = {}
    for r in got:
        by.setdefault(r["component"], {})[r["id"]] = r
    assert sorted(by) == list(range(1, k + 1))
    for j in range(k):
        want = c @ u[:, j] / math.sqrt(e[j])
        have = np.array([by[j + 1][i]["whitened"] for i, _ in rows])
        assert np.abs(have - want * np.sign(have @ want)).max() < 1e-6
        assert abs(by[j + 1][rows[0][0]]["explained"] / (e[j] / np.trace(v)) - 1) < 1e-9
    assert [by[1][i]["deviation"] for i, _ in rows] == list(far)
    assert {r["n"] for r in got} == {len(rows)}
    assert max(r["identity_error"] for r in got) < 1e-8


@pytest.mark.parametrize(("n", "dim"), [(900, 64), (300, 20), (700, 90)])
def test_against_a_dense_solver(spark, n, dim):
    r = np.random.default_rng(dim)
    rows = [(i, v) for i, v in enumerate(r.normal(size=(n, dim)) * np.linspace(1, 0.3, dim) @ np.linalg.qr(r.normal(size=(dim, dim)))[0])]
    fitted = wh.fit(frame(spark, rows).repartition(5))
    assert fitted.residual <= 1e-12
    compare(wh.whiten(fitted).collect(), rows, min(dim, 32))


def test_solver_on_wide_and_close_spectra():
    r = np.random.default_rng(2)
    for values in (10.0 ** -np.linspace(0, 9, 120), 1 + 0.3 * r.random(120), np.r_[1e6, np.ones(119)], np.r_[np.ones(10), np.zeros(110)]):
        u = np.linalg.qr(r.normal(size=(120, 120)))[0]
        v = (u * values) @ u.T
        block = np.linalg.qr(r.normal(size=(120, 48)))[0]
        got, basis, residual = wh._solve(lambda q, v=v: v @ q, block, v @ block, 32)
        want = np.sort(values)[::-1]
        want = want[:32][want[:32] > 1e-12 * want[0]]
        assert len(got) == len(want)
        assert np.abs(got - want).max() <= 1e-12 * want[0]
        assert np.abs(basis.T @ basis - np.eye(len(got))).max() < 1e-12
        assert residual < 1e-12


def test_same_result_from_many_tasks(spark, monkeypatch):
    r = np.random.default_rng(5)
    df = frame(spark, [(i, v) for i, v in enumerate(r.normal(size=(500, 10)))])
    whole = wh.fit(df.repartition(1))
    monkeypatch.setattr(wh, "DIRECT", 2)
    monkeypatch.setattr(wh, "BLOCK_BYTES", 1600)
    parts = wh.fit(df.repartition(7))
    assert np.allclose(whole.values, parts.values, rtol=1e-12)
    assert np.allclose(whole.basis, parts.basis, atol=1e-9)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -2]), (2, [1, 3]), (2, [1, 3]), (3, [-0.01, 7]), (4, [0, 1])]
    bad = [(5, None), (6, [nan, 1]), (7, [inf, 1]), (8, [None, 1]), (9, []), (10, [1, 2, 3]), (11, [1e300, 0])]
    df = frame(spark, good + [(None, [0.25, 0.25])] + bad).selectExpr("*", "1 AS id", "'x' AS y", "2 AS dim", "3 AS component")
    got = wh.whiten(wh.fit(df)).collect()
    c, far, _, e, _ = exact(good + [(0, [0.25, 0.25])])
    assert sorted((r["id"] or 0, r["component"], r["deviation"]) for r in got) == sorted(
        (i or 0, j, d) for (i, _), d in zip([*good, (None, 0)], far) for j in (1, 2))
    assert {r["id"] for r in got if r["id"] is None} == {None}
    assert wh.fit(frame(spark, [])) is None
    assert wh.fit(frame(spark, bad[:5])) is None
    for same in ([(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])]):
        assert len(wh.fit(frame(spark, same)).values) == 0
        assert wh.whiten(wh.fit(frame(spark, same))).collect() == []


def test_deviations_are_exact():
    r = np.random.default_rng(0)
    for size, n in ((50, 10), (2**20, 10**6), (2**39, 3)):
        y = r.integers(-size, size, (20, 6))
        sums = [int(s) for s in y.astype(object).sum(axis=0)]
        base, rest = np.array([s // n for s in sums]), np.array([s % n for s in sums])
        want = [int(((n * row.astype(object) - np.array(sums, object)) ** 2).sum()) for row in y]
        assert wh.deviations(y, base, rest, n) == [w if w < 2**63 else None for w in want]


def test_query_on_given_rows(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = wh.op13_whitening(spark, folder).withColumnRenamed("vec_id", "id").collect()
    compare(got, rows, 32)
