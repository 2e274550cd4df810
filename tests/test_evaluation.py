from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest

from trafficlens.operators import evaluation as ev
from trafficlens.operators import monitoring as mon


def pairs(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int")


def test_report_by_hand(spark):
    # class 0: support 3, predicted 3, hits 2; class 1: support 2, predicted 1, hits 1; class 2: predicted only
    df = pairs(spark, [(0, 0), (0, 0), (0, 2), (1, 1), (1, 0)])
    got = {r["class_name"]: r for r in ev.classification_report(df, "label", "prediction").collect()}
    assert set(got) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert (got["0"]["precision"], got["0"]["recall"], got["0"]["support"]) == pytest.approx((2 / 3, 2 / 3, 3))
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["f1_score"]) == pytest.approx((1.0, 0.5, 2 / 3))
    assert (got["2"]["precision"], got["2"]["recall"], got["2"]["f1_score"], got["2"]["support"]) == (0, 0, 0, 0)
    assert got["accuracy"]["precision"] == pytest.approx(3 / 5)
    assert got["macro avg"]["precision"] == pytest.approx((2 / 3 + 1 + 0) / 3)
    assert got["weighted avg"]["precision"] == pytest.approx((2 / 3 * 3 + 1 * 2) / 5)
    assert got["weighted avg"]["support"] == 5


def test_binary_scores_zero_division(spark):
    got = ev.binary_scores(pairs(spark, [(0, 0), (0, 0)]), "label", "prediction").first()
    assert tuple(got) == (1.0, 0.0, 0.0, 0.0)
    empty = ev.binary_scores(pairs(spark, []), "label", "prediction").first()
    assert tuple(empty) == (0.0, 0.0, 0.0, 0.0)


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [0, 1, 6])
def test_auc_with_ties(spark, digits):
    rng = np.random.default_rng(5)
    rows = [(int(rng.random() < 0.3), round(float(rng.normal()), digits)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert ev.roc_auc(df, "label", "score").first()["auc"] == pytest.approx(brute_auc(rows))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    got = ev.roc_auc(df, "label", "score").first()
    assert (got["positives"], got["negatives"], got["auc"]) == (2, 0, None)


def history(spark, values):
    start = datetime(2025, 1, 1)
    rows = [(start + timedelta(days=i), a, a, a, f, 100) for i, (a, f) in enumerate(values)]
    return spark.createDataFrame(
        rows, "timestamp timestamp, accuracy double, precision double, recall double, f1_score double, sample_size long"
    )


def test_trend_matches_numpy(spark):
    rng = np.random.default_rng(2)
    values = [(float(a), float(f)) for a, f in rng.random((14, 2))]
    got = mon.metric_trend(history(spark, values)).first()
    last = np.array(values[-10:])
    assert got["current_accuracy"] == last[-1, 0] and got["avg_f1"] == pytest.approx(last[:, 1].mean())
    assert got["accuracy_std"] == pytest.approx(last[:, 0].std())
    assert got["f1_trend"] == pytest.approx(np.polyfit(range(10), last[:, 1], 1)[0])


def test_trend_needs_enough_records(spark):
    short = history(spark, [(0.9, 0.9)] * 9)
    assert mon.metric_trend(short).count() == 0
    assert mon.retrain_decision(short).first()["retrain"] is False


@pytest.mark.parametrize("last, wanted", [((0.9, 0.9), False), ((0.7, 0.9), True), ((0.9, 0.7), True), ((0.85, 0.9), False)])
def test_retrain_rule(spark, last, wanted):
    df = history(spark, [(0.9, 0.9)] * 9 + [last])
    assert mon.retrain_decision(df).first()["retrain"] is wanted


def test_performance_record_and_summary(spark):
    record = mon.performance_record(pairs(spark, [(0, 0), (1, 0), (1, 1), (0, 0)]), "label", "prediction")
    row = record.first()
    assert row["accuracy"] == 0.75 and row["sample_size"] == 4
    got = mon.monitoring_summary(history(spark, [(0.9, 0.9)] * 10)).first()
    assert got["total_runs"] == 10 and got["retraining_needed"] is False


def test_run_log_summary_of_nothing(spark):
    runs = spark.createDataFrame(
        [], "run_id string, timestamp timestamp, mode string, execution_time_seconds double, success boolean"
    )
    got = mon.run_log_summary(runs).first()
    assert got["total_runs"] == 0 and got["success_rate"] == 0.0 and got["last_run"] is None
