"""Forests without a depth bound: against an exhaustive tree, at any partitioning, on awkward rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import deep_forest as deep


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label string")


def some_rows(n=600, seed=3, noise=0.2):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = float(r.randrange(30)), round(r.gauss(0, 1), 2), r.random()
        label = ("x" if a > 12 else "y") if r.random() > noise else r.choice("xyz")
        out.append((i, a, b, c, label))
    return out


def brute_share(x, y, row, classes):
    """Class shares of the leaf that ``row`` reaches in a tree that tries all cuts of all features at every node."""
    members = list(range(len(y)))
    while True:
        counts = Counter(y[i] for i in members)
        best = None
        if len(counts) > 1:
            for j in range(len(x[0])):
                values = sorted({x[i][j] for i in members})
                for low, high in zip(values, values[1:]):
                    t = (low + high) / 2
                    sides = [Counter(), Counter()]
                    for i in members:
                        sides[x[i][j] > t][y[i]] += 1
                    score = sum(sum(v * v for v in s.values()) / sum(s.values()) for s in sides)
                    if best is None or score > best[0] + 1e-9:
                        best = (score, j, t)
        if best is None:
            return [counts[c] / len(members) for c in classes]
        _, j, t = best
        members = [i for i in members if (x[i][j] > t) == (row[j] > t)]


def test_one_tree_equals_exhaustive_search(spark):
    rows = some_rows(150, seed=5)
    model = deep.fit(frame(spark, rows[:120]), ["a", "b", "c"], trees=1, bootstrap=False, look=3)
    x, y = [r[1:4] for r in rows[:120]], [r[4] for r in rows[:120]]
    out = {r["id"]: r["probabilities"] for r in deep.predict(frame(spark, rows), model).collect()}
    # Equal scores may be broken either way, so nearly all rows must agree, and all training rows.
    agree = [np.allclose(out[r[0]], brute_share(x, y, r[1:4], model.classes)) for r in rows]
    assert all(agree[:120]) and np.mean(agree[120:]) > 0.8


@pytest.mark.parametrize("small", [4096, 64])
def test_leaves_are_pure(spark, small):
    rows = some_rows(800)
    model = deep.fit(frame(spark, rows), ["a", "b", "c"], trees=3, bootstrap=False, small=small)
    assert all(r["prediction"] == r["label"] and r["confidence_score"] == 1.0 for r in deep.predict(frame(spark, rows), model).collect())
    leaves = [r["counts"] for r in model.nodes.filter("feature < 0 AND counts IS NOT NULL").collect()]
    assert all(np.count_nonzero(c) <= 1 for c in leaves)
    assert sum(sum(c) for c in leaves) == 3 * 800
    uppers = model.nodes.filter("root = -1 AND feature >= 0").count()
    assert (uppers > 0) == (small == 64)


def test_same_forest_however_rows_are_dealt(spark):
    df = frame(spark, some_rows(700))
    tables = []
    for parts in (1, 3, 8):
        model = deep.fit(df.repartition(parts), ["a", "b", "c"], key="id", trees=4, small=80)
        tables.append(sorted(map(str, model.nodes.collect())))
    assert tables[0] == tables[1] == tables[2]


def test_bootstrap_weights_are_poisson_and_differ_by_tree():
    keys = np.arange(50_000, dtype=np.uint64)
    first, second = (deep.weights(keys, t, 42, True) for t in (0, 1))
    for w in (first, second):
        assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(first, second)[0, 1]) < 0.02


def test_forest_generalises_and_is_kept(spark, tmp_path, monkeypatch):
    df = frame(spark, some_rows(1500, noise=0.1))
    model = deep.fit(df.filter("id < 1200"), ["a", "b", "c"], key="id", trees=20, small=300)
    out = deep.predict(df.filter("id >= 1200"), model)
    assert out.filter("prediction = label").count() / out.count() > 0.8
    model.save(str(tmp_path / "forest"))
    monkeypatch.setattr(deep, "GROUP_NODES", 1000)  # trees travel in several groups
    again = deep.predict(df.filter("id >= 1200"), deep.DeepForest.load(spark, str(tmp_path / "forest")))
    first, second = ({r["id"]: r["probabilities"] for r in o.collect()} for o in (out, again))
    assert first.keys() == second.keys() and all(np.allclose(first[i], second[i]) for i in first)


def test_equal_rows_missing_numbers_and_bounds(spark):
    nan = float("nan")
    # A third of the rows are equal and of two classes: one leaf, which no task needs to split.
    rows = [(i, 1.0, 1.0, 1.0, "x" if i % 3 else "y") for i in range(300)] + [(1000 + i, None if i % 2 else nan, 2.0, float(i), "z") for i in range(200)]
    rows += [(2000 + i, float(i), 3.0, 0.5, "w") for i in range(400)] + [(9999, 1.0, 1.0, 1.0, None)]
    model = deep.fit(frame(spark, rows), ["a", "b", "c"], trees=2, bootstrap=False, small=50)
    out = {r["id"]: r for r in deep.predict(frame(spark, rows), model).collect()}
    assert out[9999]["prediction"] == "x" and out[0]["probabilities"] == pytest.approx([0.0, 2 / 3, 1 / 3, 0.0])
    assert all(out[i]["prediction"] == "z" for i in range(1000, 1200)) and all(out[i]["prediction"] == "w" for i in range(2000, 2400))
    with pytest.raises(ValueError):
        deep.fit(frame(spark, []), ["a"])
    few = deep.fit(frame(spark, rows), ["a"], trees=1, fit_rows=200)
    assert 50 < sum(sum(r["counts"]) for r in few.nodes.filter("counts IS NOT NULL").collect()) < 600
    assert deep.predict(frame(spark, []), few).collect() == []


def test_trees_too_large_to_be_sent_score_the_same(spark, monkeypatch):
    df = frame(spark, [*some_rows(900, noise=0.4), (5000, None, 1.0, float("nan"), "x"), (5001, None, 1.0, float("nan"), "y")])
    # Most classes are told by one cut, so some rows end in the upper part of a tree.
    df = df.withColumn("label", F.when(F.col("a") < 4, "w").otherwise(F.col("label")))
    model = deep.fit(df, ["a", "b", "c"], key="id", trees=5, small=60)
    assert model.nodes.filter("root = -1 AND feature < 0 AND counts IS NOT NULL").count()
    sent = {r["id"]: r for r in deep.predict(df, model).collect()}
    monkeypatch.setattr(deep, "GROUP_NODES", 100)  # every tree has more nodes than that
    collected = []
    whole = type(df).toPandas
    monkeypatch.setattr(type(df), "toPandas", lambda self: collected.append(whole(self)) or collected[-1])
    routed = deep.predict(df, model)
    assert routed.columns == deep.predict(df, model).columns == [*df.columns, "probabilities", "prediction", "confidence_score"]
    found = {r["id"]: r for r in routed.collect()}
    assert found.keys() == sent.keys()
    assert all(found[i]["prediction"] == sent[i]["prediction"] and np.allclose(found[i]["probabilities"], sent[i]["probabilities"], atol=1e-12) for i in sent)
    # Only the upper parts reach the driver.
    assert all((c["root"] == -1).all() for c in collected) and 4 * sum(map(len, collected)) < 3 * 2 * model.nodes.count()
    assert deep.predict(df.limit(0), model).collect() == []


def test_levels_count_cells_and_not_rows(spark, monkeypatch):
    written = {}
    whole = deep.materialize

    def kept(df, label):
        written[label] = whole(df, label)
        return written[label]

    monkeypatch.setattr(deep, "materialize", kept)
    rows = spark.range(20_000).selectExpr("cast(id % 7 as double) a", "cast(id % 11 as double) b", "case when id % 5 = 0 then 'x' else 'y' end label")
    model = deep.fit(rows, ["a", "b"], trees=2, bootstrap=False, look=2, small=300)
    cells = written["forest-cells"]
    # At most one cell per class and pair of bins, and all rows are in them.
    assert cells.count() <= 7 * 11 * 2 and cells.agg(F.sum("w")).first()[0] == 20_000
    leaves = model.nodes.filter("feature < 0 AND counts IS NOT NULL").collect()
    assert sum(sum(r["counts"]) for r in leaves) == 2 * 20_000
    out = deep.predict(rows, model).groupBy("a", "b").agg(F.count_distinct("prediction").alias("n"), F.max("confidence_score").alias("c")).collect()
    assert len(out) == 77 and all(r["n"] == 1 for r in out)


def test_equal_rows_are_dealt_out_once_per_stretch():
    x = np.array([[1.0, -0.0], [1.0, 0.0], [2.0, -np.inf], [1.0, 0.0]])
    y, w, numbers, root = deep._merged_rows(np.array([0, 0, 1, 1]), np.array([2, 3, 1, 4]), x, np.array([5, 5, 6, 5]))
    found = sorted(zip(root.tolist(), y.tolist(), w.tolist(), numbers.tolist()))
    assert found == [(5, 0, 5, [1.0, 0.0]), (5, 1, 4, [1.0, 0.0]), (6, 1, 1, [2.0, -np.inf])]


def test_rows_of_large_trees_are_scored_without_a_join(spark, monkeypatch):
    df = frame(spark, some_rows(600, noise=0.4))
    model = deep.fit(df, ["a", "b", "c"], key="id", trees=2, small=60)
    monkeypatch.setattr(deep, "GROUP_NODES", 100)
    monkeypatch.setattr(deep, "_CHAINED", 1)  # rows are written between trees
    out = deep.predict(df, model)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    monkeypatch.setattr(deep, "GROUP_NODES", 200_000)
    sent = {r["id"]: r["probabilities"] for r in deep.predict(df, model).collect()}
    assert {r["id"]: r["probabilities"] for r in out.collect()} .keys() == sent.keys()
