from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import classifiers, iforest, one_class


def cloud(spark, n=600, outliers=6, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (n, 2)))]
    rows += [(n + i, 12.0 + i, -12.0 - i) for i in range(outliers)]
    return spark.createDataFrame(rows, "id long, x double, y double")


def by_id(df, column="anomaly_score"):
    return {r["id"]: r[column] for r in df.select("id", column).collect()}


def test_expected_path():
    got = iforest.expected_path(np.array([0, 1, 2, 3, 256]))
    harmonic = 2 * (math.log(255) + np.euler_gamma) - 2 * 255 / 256
    assert got[:3].tolist() == [0, 0, 1] and got[4] == pytest.approx(harmonic)


def test_forest_finds_planted_outliers_at_any_partitioning(spark):
    df = cloud(spark)
    results = {}
    for parts in (1, 3, 8):
        scored, model = iforest.detect(df.repartition(parts), "id", ["x", "y"], 0.05, trees=40)
        results[parts] = by_id(scored)
    # Imputation means are sums of doubles, so equality is up to their rounding.
    for parts in (3, 8):
        assert results[1] == pytest.approx(results[parts], abs=1e-9)
    lowest = sorted(results[1], key=results[1].get)[:6]
    assert set(lowest) == set(range(600, 606))
    flagged = sum(v < 0 for v in results[1].values())
    assert abs(flagged - 0.05 * 606) <= 1


def test_forest_sample_is_bounded(spark):
    df = spark.range(20_000).select("id", F.array(F.col("id").cast("double")).alias("x"))
    drawn = iforest._draw(df, "id", 20_000, 256, 20, 42)
    sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert sizes == [256] * 20
    ids = [r[0] for r in drawn.select(F.col("x")[0]).collect()]
    assert abs(np.mean(ids) - 10_000) < 500


def test_forest_saved_and_loaded(spark, tmp_path):
    df = cloud(spark, 200, 3)
    scored, model = iforest.detect(df, "id", ["x", "y"], trees=20)
    model.save(spark, str(tmp_path / "forest"))
    again = iforest.IsolationForest.load(spark, str(tmp_path / "forest"))
    assert by_id(iforest.score_forest(df, again)) == by_id(scored)
    assert again.offset == model.offset and len(again.nodes) <= 2 * 20 * model.sample_size


def test_forest_nulls_and_constants(spark):
    df = spark.createDataFrame([(i, None if i == 3 else float(i), 1.0) for i in range(20)], "id long, x double, c double")
    scored, _ = iforest.detect(df, "id", ["x", "c"], trees=10)
    assert scored.filter("anomaly_score IS NULL").count() == 0
    flat = df.select("id", "c")
    none, _ = iforest.detect(flat, "id", ["c"], trees=5)
    assert none.filter("prediction = 1").count() == 0


def test_forest_on_one_row_and_none(spark):
    one = spark.createDataFrame([(1, 5.0)], "id long, x double")
    scored, _ = iforest.detect(one, "id", ["x"], "auto", trees=3)
    assert scored.count() == 1
    with pytest.raises(ValueError, match="empty"):
        iforest.fit_forest(one.filter("id > 1"), "id", ["x"])


def test_auto_threshold(spark):
    scored, model = iforest.detect(cloud(spark), "id", ["x", "y"], "auto", trees=40)
    assert model.offset == -0.5
    flagged = {i for i, v in by_id(scored).items() if v < 0}
    assert set(range(600, 606)) <= flagged and len(flagged) < 120


def test_one_class_flags_nu_and_outliers(spark):
    df = cloud(spark)
    results = {}
    for parts in (1, 8):
        scored, model = one_class.detect_one_class(df.repartition(parts), ["x", "y"], 0.1)
        results[parts] = by_id(scored)
    assert results[1] == pytest.approx(results[8], abs=1e-6)
    flagged = {i for i, v in results[1].items() if v < 0}
    assert set(range(600, 606)) <= flagged
    assert abs(len(flagged) - 0.1 * 606) <= 1


def test_one_class_saved_and_loaded(spark, tmp_path):
    df = cloud(spark, 150, 3)
    model = one_class.fit_one_class(df, ["x", "y"], steps=2)
    model.save(spark, str(tmp_path / "m"))
    again = one_class.OneClassModel.load(spark, str(tmp_path / "m"))
    assert by_id(one_class.score_one_class(df, again)) == by_id(one_class.score_one_class(df, model))


def test_one_class_reaches_the_optimum(spark):
    """The duality gap, computed from the mapped rows themselves, is within the tolerance."""
    df = cloud(spark, 300, 6)
    model = one_class.fit_one_class(df, ["x", "y"], nu=0.1)
    x = np.array([(r["x"], r["y"]) for r in df.collect()])
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    mapped = one_class._mapped(x, *one_class._projection(2, model.width, model.gamma, model.seed))
    w = model.weights
    scores = np.sort(mapped @ w)
    target = 0.1 * len(x)
    lowest = (scores[: int(target)].sum() + (target - int(target)) * scores[int(target)]) / target
    assert 0 <= w @ w - lowest <= 2 * one_class.TOLERANCE * (w @ w)
    assert model.rho == pytest.approx(np.quantile(mapped @ w, 0.1))


def test_forest_scores_by_walking_the_trees(spark):
    df = cloud(spark, 300, 4)
    model = iforest.fit_forest(df, "id", ["x", "y"], trees=15)
    trees = [t.set_index("node") for _, t in model.nodes.groupby("tree")]

    def walk(row):
        total = 0.0
        for t in trees:
            at = 0
            while t.loc[at, "feature"] >= 0:
                n = t.loc[at]
                at = int(n["left"] if (row["x"], row["y"])[int(n["feature"])] < n["threshold"] else n["right"])
            total += t.loc[at, "path"]
        return -(2.0 ** (-total / len(trees) / float(iforest.expected_path(model.sample_size))))

    for r in iforest.raw_scores(df, model).filter("id % 40 = 0 OR id >= 300").collect():
        assert r["raw_score"] == pytest.approx(walk(r))


def labelled(spark, n=400):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        rows.append((i, float(rng.normal(4 * y, 1)), None if i % 50 == 0 else float(rng.normal()), y))
    return spark.createDataFrame(rows, "id long, a double, b double, label int")


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)] + [(None,)], "label int")
    got = {r["label"]: r["weight"] for r in classifiers.class_weights(df, "label").collect()}
    assert got == pytest.approx({0: 4 / 6, 1: 2.0})


def test_random_forest_on_held_out_rows(spark, tmp_path):
    df = labelled(spark)
    model, scored = classifiers.train_and_evaluate(df, "id", ["a", "b"], trees=10, max_depth=4, balanced=True)
    right = scored.filter("label = prediction").count() / scored.count()
    assert right > 0.85
    weight = classifiers.feature_importance(model, ["a", "b"])
    assert weight["a"] > weight["b"]
    classifiers.save_model(model, str(tmp_path / "rf"))
    again = classifiers.load_model(str(tmp_path / "rf"))
    a = classifiers.predict_binary(df, model, "id", "random_forest").orderBy("session_id").collect()
    b = classifiers.predict_binary(df, again, "id", "random_forest").orderBy("session_id").collect()
    assert a == b and all(r["confidence_score"] >= 0.5 - 1e-9 for r in a)


def test_random_forest_on_one_class(spark):
    df = labelled(spark, 60).withColumn("label", F.lit(0))
    model = classifiers.fit_random_forest(df, ["a", "b"], trees=3, max_depth=2)
    rows = classifiers.predict_binary(df, model, "id", "random_forest").collect()
    assert {(r["prediction"], r["probability"], r["confidence_score"]) for r in rows} == {(0, 0.0, 1.0)}


def test_boosted_trees(spark):
    df = labelled(spark, 200)
    model = classifiers.fit_boosted_trees(df, ["a", "b"], rounds=3)
    out = model.transform(df)
    assert out.filter("label = prediction").count() > 170


def test_traffic_types_with_unseen_protocol(spark):
    rows = [(float(i % 7), 10.0 if i % 2 else 500.0, "TCP" if i % 2 else "UDP", "dns" if i % 2 else None if i == 0 else "http") for i in range(60)]
    df = spark.createDataFrame(rows, "source_port double, packet_size double, protocol string, traffic_type string")
    model = classifiers.fit_traffic_types(df, features=["source_port", "packet_size"], trees=5, max_depth=3)
    new = spark.createDataFrame([(1.0, 10.0, "TCP"), (2.0, None, "ICMP")], "source_port double, packet_size double, protocol string")
    got = classifiers.predict_traffic_types(new, model).collect()
    assert got[0]["predicted_traffic_type"] == "dns"
    assert got[1]["predicted_traffic_type"] in ("dns", "http") and 0.5 <= got[1]["prediction_confidence"] <= 1


def packets(spark):
    from datetime import datetime, timedelta

    start = datetime(2025, 12, 10)
    rows = [
        ("a" if i % 3 else "b", "x", start + timedelta(minutes=10 * i), 5000 if 120 <= i < 126 else 100 + i % 5)
        for i in range(240)
    ]
    return spark.createDataFrame(rows, "source_ip string, dest_ip string, timestamp timestamp, packet_size long")


def test_hybrid_hourly_with_and_without_labels(spark):
    from trafficlens.plans.jobs import hybrid_hourly

    df = packets(spark)
    labels = df.select("timestamp", F.when(F.col("packet_size") > 1000, 1).otherwise(0).alias("prediction"))
    got = {r["hour"].hour + 24 * (r["hour"].day - 10): r for r in hybrid_hourly(df, labels, trees=5, max_depth=3).collect()}
    assert len(got) == 40
    assert [h for h, r in got.items() if r["final_prediction"] == 1] == [20]
    assert got[20]["final_label"] == "anomaly" and {r["supervised_label"] for h, r in got.items() if h != 20} <= {"normal", None}
    assert sum(r["supervised_label"] is not None for r in got.values()) >= 10
    alone = hybrid_hourly(df).collect()
    assert len(alone) == 40 and all(r["supervised_prediction"] is None for r in alone)
    assert all(r["final_prediction"] == r["prediction"] for r in alone)
    no_match = labels.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 second"))
    assert hybrid_hourly(df, no_match).filter("supervised_prediction IS NOT NULL").count() == 0


def test_depth_and_classes_are_checked(spark):
    df = spark.range(60).selectExpr("cast(id as double) a", "cast(id % 2 as int) label", "concat('t', id) traffic_type")
    with pytest.raises(ValueError, match="at most 30"):
        classifiers.fit_random_forest(df, ["a"], trees=2, max_depth=40)
    limit, classifiers.MAX_CLASSES = classifiers.MAX_CLASSES, 10
    try:
        with pytest.raises(ValueError, match="more than 10"):
            classifiers.fit_traffic_types(df, features=["a"], protocol=None, trees=2)
        with pytest.raises(ValueError, match="more than 10"):
            classifiers.with_class_weight(df, "traffic_type")
    finally:
        classifiers.MAX_CLASSES = limit


def test_whole_numbers_are_filled_with_the_exact_mean(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (4, 1), (None, 1)], "a int, label int")
    model = classifiers.fit_random_forest(df, ["a"], trees=2, max_depth=2)
    filled = model.transform(df).filter("a is null").first()["_filled_0"]
    assert abs(filled - 7 / 3) < 1e-12


def test_fit_rows_bound(spark):
    df = spark.range(5000).selectExpr("id", "cast(id % 7 as double) a", "cast(id % 2 as int) label")
    kept = classifiers.bounded(df, 500)
    assert 350 < kept.count() < 650
    assert {r["id"] for r in kept.collect()} == {r["id"] for r in classifiers.bounded(df.repartition(5), 500).collect()}
    assert classifiers.bounded(df, 5000).count() == 5000


def test_one_class_tells_whether_it_converged(spark):
    from trafficlens.operators import one_class

    df = cloud(spark)
    whole = one_class.fit_one_class(df, ["x", "y"])
    short = one_class.fit_one_class(df, ["x", "y"], steps=1)
    assert whole.converged and whole.gap <= one_class.TOLERANCE
    assert short.converged == (short.gap <= one_class.TOLERANCE) and short.gap >= whole.gap - 1e-9


def test_passes_of_a_fit_read_the_table_once(spark, tmp_path, monkeypatch):
    from trafficlens.operators import classifiers

    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(900).selectExpr("id", "cast(id % 30 as double) a", "cast(id % 2 as int) label", "case when id % 2 = 0 then 'x' else 'y' end kind")
    watched = rows.mapInArrow(read, rows.schema)
    for fit, reads in (
        (lambda: classifiers.fit_random_forest(watched, ["a"], trees=2, max_depth=2, fit_rows=400), 2),
        (lambda: classifiers.fit_boosted_trees(watched, ["a"], rounds=2, max_depth=2, fit_rows=400), 2),
        (lambda: classifiers.fit_traffic_types(watched, "kind", ["a"], None, trees=2, max_depth=2, fit_rows=400), 4),
    ):
        before = seen.value
        fit()
        # Once to count and once for the rows to fit on; the most frequent target is found once for each.
        assert seen.value - before <= reads * 900
    assert not spark.sparkContext._jsc.getPersistentRDDs()
