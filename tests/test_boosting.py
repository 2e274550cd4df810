"""Boosted trees against an exhaustive search, and their behaviour on awkward tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from trafficlens.operators import boosting


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label string")


def some_rows(n=400, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.randrange(12), round(r.gauss(0, 1), 1), r.random()
        label = "z" if a > 8 else "x" if b + 0.3 * r.gauss(0, 1) > 0 else "y"
        out.append((i, float(a), b, c, label))
    return out


def brute_tree(x, g, h, depth, path=0):
    """{node: (feature, threshold) or leaf value} by trying every cut of every feature."""
    def part(m):
        return g[m].sum() ** 2 / (h[m].sum() + 1.0)

    everything = np.ones(len(g), bool)
    best = None
    if depth:
        for j in range(x.shape[1]):
            for t in sorted(set(x[:, j]))[:-1]:
                left = x[:, j] <= t
                if h[left].sum() < 1 or h[~left].sum() < 1:
                    continue
                gain = part(left) + part(~left) - part(everything)
                if gain > boosting.LEAST_GAIN and (best is None or gain > best[0] + 1e-9):
                    best = (gain, j, t, left)
    if best is None:
        return {path: -boosting.STEP * g.sum() / (h.sum() + 1.0)}
    _, j, t, left = best
    return {path: (j, t), **brute_tree(x[left], g[left], h[left], depth - 1, 2 * path + 1), **brute_tree(x[~left], g[~left], h[~left], depth - 1, 2 * path + 2)}


def test_first_round_equals_exhaustive_search(spark):
    rows = [(i, a, b, float(int(c * 20)), y) for i, a, b, c, y in some_rows()]
    model = boosting.fit(frame(spark, rows), ["a", "b", "c"], rounds=1, depth=3, bins=200)
    x = np.array([r[1:4] for r in rows])
    for k, name in enumerate(["x", "y", "z"]):
        g = 1 / 3 - np.array([r[4] == name for r in rows])
        want = brute_tree(x, g, np.full(len(rows), 2 / 3 * 2 / 3), 3)
        mine = model.nodes[model.nodes["class"] == k].set_index("node")
        assert set(mine.index) == set(want)
        for node, w in want.items():
            if isinstance(w, tuple):
                assert (mine["feature"][node], mine["threshold"][node]) == w
            else:
                assert mine["feature"][node] == -1 and abs(mine["value"][node] - w) < 1e-6
        leaves = mine[mine["feature"] < 0]
        assert leaves["rows"].sum() == len(rows)


def test_loss_falls_and_predictions_follow(spark):
    df = frame(spark, some_rows(1500))
    model = boosting.fit(df, ["a", "b", "c"], rounds=6, depth=3)
    assert len(model.losses) == 7 and model.losses[0] == pytest.approx(math.log(3), abs=1e-6)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:]))
    out = boosting.predict(df, model).collect()
    assert sum(r["prediction"] == r["label"] for r in out) / len(out) > 0.9
    # The reported loss is that of the predictions.
    at = {c: i for i, c in enumerate(model.classes)}
    assert np.mean([-math.log(r["probabilities"][at[r["label"]]]) for r in out]) == pytest.approx(model.losses[-1], abs=1e-6)
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 and r["confidence_score"] == max(r["probabilities"]) for r in out)


def test_same_trees_however_rows_are_dealt(spark, monkeypatch):
    df = frame(spark, some_rows(700))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    models = [boosting.fit(df.repartition(p), ["a", "b", "c"], rounds=3, depth=2, bins=16) for p in (1, 3, 8)]
    for other in models[1:]:
        assert other.nodes.equals(models[0].nodes)
        assert other.losses == models[0].losses
    monkeypatch.setattr(boosting, "WRITE_EVERY", 100)
    whole = boosting.fit(df, ["a", "b", "c"], rounds=3, depth=2, bins=16)
    assert whole.nodes.equals(models[0].nodes)


def test_stored_blocks_are_small_and_read_in_place():
    rows, width, classes = 20_000, 5, 3
    x, y = np.random.default_rng(1).integers(0, 40, (rows, width)).astype(float), np.arange(rows) % classes
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(x.ravel()))
    batch = pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), lists], names=["y", "x"])
    edges = [[float(v) for v in range(40)]] * width
    packed = list(boosting._packer(edges, classes)(iter([batch, batch.slice(0, 0), batch.slice(7, 3)])))
    # A read batch holds thousands of blocks, so a block has few bytes however long the table is.
    assert max(len(b) for p in packed for c in p.columns[1:] for b in c.to_pylist()) <= 4096
    parts = list(boosting._opened(iter([packed[0], packed[0].slice(3, 4), *packed[1:]]), width, classes))
    size = packed[0].column(0)[0].as_py()
    assert max(len(y) for y, _, _ in parts) <= boosting.BLOCK_ROWS and all(len(b) == len(m) == len(y) for y, b, m in parts)
    back = np.concatenate([*[np.arange(rows), np.arange(3 * size, 7 * size), np.arange(7, 10)]])
    assert np.array_equal(np.concatenate([p[0] for p in parts]), y[back])
    assert np.array_equal(np.concatenate([p[1] for p in parts]), boosting.bin_numbers(x, edges)[back])


def test_saved_model_predicts_the_same(spark, tmp_path):
    df = frame(spark, some_rows(300))
    model = boosting.fit(df, ["a", "b"], rounds=3, depth=2)
    model.save(spark, str(tmp_path / "m"))
    again = boosting.BoostedTrees.load(spark, str(tmp_path / "m"))
    first, second = (sorted(map(str, boosting.predict(df, m).collect())) for m in (model, again))
    assert first == second
    shares = {r["feature"]: r for r in boosting.importance(spark, model).collect()}
    assert sum(r["importance"] for r in shares.values()) == pytest.approx(1.0)
    assert [r["loss"] for r in boosting.losses(spark, again).orderBy("round").collect()] == model.losses


def test_missing_numbers_lie_below_all_others(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, 1.0, None, y) for i, (v, y) in enumerate([(None, "m"), (nan, "m"), (inf, "m"), (1.0, "n"), (2.0, "n"), (-5.0, "n")] * 20)]
    df = frame(spark, rows)
    model = boosting.fit(df, ["a", "b", "c"], rounds=2, depth=2)
    assert all(r["prediction"] == r["label"] for r in boosting.predict(df, model).collect())
    # Constant and empty features are never cut.
    assert set(model.nodes["feature"]) == {-1, 0}


def test_one_class_no_rows_and_unlabelled_rows(spark):
    alone = boosting.fit(frame(spark, [(1, 1.0, 2.0, 3.0, "only"), (2, 5.0, 1.0, 0.0, "only"), (3, 0.0, 0.0, 0.0, None)]), ["a", "b"], rounds=2)
    assert alone.classes == ["only"] and alone.losses[-1] == 0.0
    assert {r["prediction"] for r in boosting.predict(frame(spark, [(9, 1.0, 1.0, 1.0, None)]), alone).collect()} == {"only"}
    with pytest.raises(ValueError):
        boosting.fit(frame(spark, []), ["a"])
    model = boosting.fit(frame(spark, some_rows(50)), ["a"], rounds=1)
    assert boosting.predict(frame(spark, []), model).collect() == []


def test_many_valued_features_are_cut_at_quantiles(spark):
    df = spark.range(1000).selectExpr("id", "cast(id as double) a", "cast(id % 3 as double) b")
    # A hot row counts in the quantiles, not in what is collected.
    hot = df.unionByName(spark.range(3000).selectExpr("id", "2000D a", "0D b"))
    assert boosting.feature_edges(hot, ["a", "b"], 4) == [[999.0, 2000.0], [0.0, 1.0, 2.0]]
    assert boosting.feature_edges(df, ["a", "b"], 4) == [[249.0, 499.0, 749.0, 999.0], [0.0, 1.0, 2.0]]
    x = np.array([[0.0, 0.0], [249.0, 1.0], [250.0, 5.0], [np.nan, np.nan]])
    assert boosting.bin_numbers(x, [[249.0, 499.0, 749.0, 999.0], [0.0, 1.0, 2.0]]).tolist() == [[1, 1], [1, 2], [2, 4], [0, 0]]
