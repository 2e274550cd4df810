from __future__ import annotations

import numpy as np
import pytest

from trafficlens.llm import one_bit


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def brute(rows, queries, k):
    out = {}
    for q, qv in queries.items():
        near = [(float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, qv)))), i) for i, v in rows if i != q and len(v) == len(qv)]
        out[q] = sorted(near)[:k]
    return out


@pytest.mark.parametrize(("dim", "eps"), [(64, 3.0), (70, 3.0), (5, 3.0)])
def test_recall_against_brute_force(spark, dim, eps):
    r = np.random.default_rng(dim)
    centres = r.normal(size=(20, dim))
    rows = [(i, centres[i % 20] + 0.3 * r.normal(size=dim)) for i in range(3000)]
    df = frame(spark, rows).repartition(5)
    got = {}
    for x in one_bit.nearest(df, df.where("vec_id % 100 = 0"), eps=eps).collect():
        got.setdefault(x["query_id"], {})[x["rank"]] = (x["vec_id"], x["score"])
    want = brute(rows, {i: v for i, v in rows if i % 100 == 0}, 10)
    hits = sum(len({v for v, _ in got[q].values()} & {i for _, i in near}) for q, near in want.items())
    assert hits / (10 * len(want)) >= 0.99
    assert all(sorted(x) == list(range(1, 11)) for x in got.values())


def test_error_bound_holds_for_nearly_all():
    r = np.random.default_rng(1)
    dim, vectors = 96, r.normal(size=(4000, 96))
    mean, turn = vectors.mean(axis=0), one_bit.rotation(96)
    codes = one_bit.Codes(vectors, mean, turn)
    unit = (vectors - mean) / codes.length[:, None]
    outside = 0
    for _ in range(20):
        q = r.normal(size=dim)
        query = one_bit.TurnedQuery(q, mean, turn)
        product, error = codes.estimate(query, 3.0)
        true = unit @ ((q - mean) / query.length)
        outside += int((np.abs(product - true) > error).sum())
        assert abs((product - true).mean()) < 0.02
    assert outside / 80_000 < 0.01


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [1, 0]), (2, [1, 0]), (3, None), (4, []), (5, [0, 0]), (6, [nan, 1]), (7, [inf, 1]), (8, [None, 1]),
            (9, [1, 2, 3]), (None, [1, 1]), (10, [3, 4]), (10, [3, 4]), (11, [1e-3, 1])]
    df = frame(spark, rows).selectExpr("*", "'a' AS v", "1 AS dim", "2 AS qb")
    got = one_bit.nearest(df, df.where("vec_id in (0, 3, 5, 9, 10)")).collect()
    by = {}
    for x in got:
        by.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], round(x["score"], 6)))
    assert set(by) == {0, 10}
    assert sorted(by[0]) == [(1, 1, 0.0), (2, 2, 0.0), (3, 11, round(np.sqrt(0.999**2 + 1), 6)), (4, 10, round(np.sqrt(20), 6)), (5, 10, round(np.sqrt(20), 6))]
    assert [v for _, v, _ in sorted(by[10])] == [11, 0, 1, 2]


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)]
    df = frame(spark, rows).repartition(4)
    got = sorted((x["rank"], x["vec_id"]) for x in one_bit.nearest(df, df.where("vec_id = 100")).collect())
    assert got == [(i + 1, i) for i in range(10)]


def test_several_query_blocks(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=8)) for i in range(400)]
    df = frame(spark, rows)
    whole = {tuple(x) for x in one_bit.nearest(df, df.where("vec_id % 5 = 0")).collect()}
    monkeypatch.setattr(one_bit, "QUERY_BLOCK", 9)
    monkeypatch.setattr(one_bit, "BROADCAST_BYTES", 0)
    assert {tuple(x) for x in one_bit.nearest(df, df.where("vec_id % 5 = 0")).collect()} == whole


def test_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, [(0, [1.0]), (1, [2.0])])
    assert one_bit.nearest(none, none).collect() == []
    assert one_bit.nearest(some, none).collect() == []
    assert one_bit.nearest(none, some).collect() == []
