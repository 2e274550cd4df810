from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import correlation, quality, rollups, rules
from trafficlens.plans.views import register_views

T0 = datetime(2025, 12, 10)


def packets(spark, rows):
    data = [(i, s, d, T0 + timedelta(seconds=t), size) for i, (s, d, t, size) in enumerate(rows)]
    return spark.createDataFrame(
        data, "id int, source_ip string, dest_ip string, timestamp timestamp, packet_size long"
    )


@pytest.mark.parametrize("slice_seconds", [1, 60, 900, 10**9])
def test_interarrival_over_slices(spark, slice_seconds):
    df = packets(spark, [
        ("a", "x", 0, 1), ("a", "x", 0.05, 1), ("a", "x", 4000, 1), ("b", "x", 10, 1),
        ("a", "x", 4000, 1), (None, "x", 1, 1), (None, "x", 5, 1),
    ])
    got = rules.interarrival(df, "source_ip", "timestamp", "id", slice_seconds=slice_seconds)
    gaps = [r["diff_seconds"] for r in got.orderBy("id").collect()]
    assert gaps == pytest.approx([0, 0.05, 3999.95, 0, 0, 0, 0])
    assert got.columns == [*df.columns, "diff_seconds"]


def test_interarrival_spreads_a_hot_source(spark):
    df = spark.range(5000).select(
        "id", F.lit("hot").alias("source_ip"), F.timestamp_seconds(F.col("id") * 7).alias("timestamp")
    )
    got = rules.interarrival(df, "source_ip", "timestamp", "id")
    assert got.filter("diff_seconds = 7").count() == 4999
    assert got.filter("diff_seconds = 0").count() == 1


def test_rule_labels_boundaries(spark):
    df = packets(spark, [
        ("a", "x", 0, 50), ("a", "x", 10, 49), ("a", "x", 20, 4500), ("a", "x", 30, 4501),
        ("a", "x", 30.05, 100), ("a", "x", 30.15, 100), ("a", "x", 30.15, 100), ("a", "x", 40, None),
    ])
    got = rules.rule_labels(df).orderBy("id").collect()
    assert [r["anomaly_flag"] for r in got] == [0, 1, 0, 1, 1, 0, 0, 0]
    assert [r["anomaly_score"] for r in got][:2] == [1, -1]
    assert got[1]["traffic_type"] == "anomaly"


def test_zscore_overrides_and_defaults(spark):
    values = [(i, 10.0 + i % 2, 0, "normal") for i in range(20)] + [(20, 500.0, 0, "normal"), (21, None, 1, "anomaly")]
    df = spark.createDataFrame(values, "id int, x double, prediction int, traffic_type string")
    got = {r["id"]: r for r in rules.zscore_flags(df, ["x", "absent"]).collect()}
    assert got[20]["prediction"] == 1 and got[20]["traffic_type"] == "anomaly"
    assert got[21]["prediction"] == 1 and not got[21]["x_anomaly"]
    assert got[0]["prediction"] == 0
    plain = rules.zscore_flags(df.select("id", "x"), ["x"]).filter("prediction = 1").collect()
    assert [r["id"] for r in plain] == [20]


def test_zscore_without_spread(spark):
    constant = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    assert rules.zscore_flags(constant, ["x"]).filter("statistical_anomaly").count() == 0
    single = constant.filter("id = 1")
    assert rules.zscore_flags(single, ["x"]).first()["prediction"] == 0
    assert rules.zscore_flags(constant.filter("id > 5"), ["x"]).count() == 0


def test_hourly_features_fills_empty_hours(spark):
    df = packets(spark, [("a", "x", 0, 10), ("b", "x", 60, 30), ("a", "y", 3 * 3600, 7)])
    got = rollups.hourly_features(df).orderBy("hour").collect()
    assert len(got) == 4
    first = got[0].asDict()
    assert (first["packet_count"], first["avg_packet_size"], first["min_packet_size"], first["max_packet_size"]) == (2, 20.0, 10, 30)
    assert first["std_packet_size"] == pytest.approx(200**0.5)
    assert (first["unique_source_ips"], first["unique_dest_ips"]) == (2, 1)
    assert got[1]["packet_count"] == 0 and got[1]["avg_packet_size"] == 0.0
    assert got[3]["std_packet_size"] == 0.0


def test_hourly_features_of_nothing(spark):
    assert rollups.hourly_features(packets(spark, []).filter("id > 0")).count() == 0


def test_resample_and_gaps(spark):
    df = packets(spark, [("a", "x", 0, 10), ("a", "x", 1, 20), ("a", "x", 2 * 3600, 7)])
    got = [r["mean_packet_size"] for r in rollups.hourly_resample(df, "timestamp", "packet_size").orderBy("hour").collect()]
    assert got == [15.0, None, 7.0]
    gaps = rollups.hourly_gaps(df, df, "timestamp", "timestamp")
    assert [r["hour"] for r in gaps.collect()] == [T0 + timedelta(hours=1)]


def test_backfill_hours(spark):
    got = rollups.backfill_hours("2025-12-10 22:30:00", "2025-12-11 00:10:00", spark).orderBy("timestamp").collect()
    assert [r["packet_size"] for r in got] == [2374, 2391, 2000]
    assert got[1]["source_ip"] == "192.168.23.1" and got[1]["dest_ip"] == "192.168.24.2"
    assert rollups.backfill_hours("2025-12-10 05:00:00", "2025-12-10 03:00:00", spark).count() == 0


def test_hourly_metrics_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(
        "id", F.timestamp_seconds(F.col("id") * 13).alias("t"), (F.col("id") % 17).cast("double").alias("v")
    )
    a = sorted(tuple(r) for r in rollups.hourly_metrics(df.repartition(1), "t", ["v"]).collect())
    b = sorted(tuple(r) for r in rollups.hourly_metrics(df.repartition(7), "t", ["v"]).collect())
    assert a == b


def test_histogram(spark):
    values = [0.0, 1.0, 1.0, 9.99, 10.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = rollups.size_histogram(df, "v", bins=5).orderBy("bin").collect()
    assert [r["row_count"] for r in got] == list(np.histogram(values, bins=5)[0])
    assert got[0]["bin_low"] == 0.0 and got[4]["bin_high"] == pytest.approx(10.0)
    assert got[0]["mean_value"] == pytest.approx(np.mean(values)) and got[0]["median_value"] == 1.0


def test_histogram_of_a_constant(spark):
    got = rollups.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [r["row_count"] for r in got] == list(np.histogram([3.0, 3.0], bins=4)[0])
    assert got[0]["bin_low"] == 2.5


@pytest.mark.parametrize("limit", [12, 1])
def test_correlation_narrow_and_wide(spark, monkeypatch, limit):
    """Pairwise complete, as a data frame library gives it, on both paths."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(1000, 1, (200, 3)), columns=["a", "b", "d"])
    frame["d"] += 2 * frame["a"]
    frame["c"] = 4.1
    frame.loc[rng.random(200) < 0.2, "a"] = None
    frame.loc[rng.random(200) < 0.2, "d"] = None
    want = frame.corr()
    schema = ", ".join(f"{c} double" for c in frame.columns)
    df = spark.createDataFrame([tuple(None if v != v else v for v in r) for r in frame.itertuples(index=False)], schema)
    monkeypatch.setattr(correlation, "PAIRWISE_LIMIT", limit)
    rows = correlation.correlation_long(df.repartition(3), list(frame.columns)).collect()
    assert len(rows) == 16
    for r in rows:
        expected = want.loc[r["column_a"], r["column_b"]]
        if "c" in (r["column_a"], r["column_b"]):
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(expected, abs=1e-9)


def test_summary_of_empty_table(spark):
    df = spark.createDataFrame([], "is_anomaly int")
    assert tuple(rollups.summary_stats(df).first()) == (0, 0, 0, 0.0)


def test_distribution(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "t string")
    got = {r["t"]: (r["row_count"], r["share_percent"]) for r in rollups.distribution(df, "t").collect()}
    assert got == {"a": (2, 50.0), None: (1, 25.0), "b": (1, 25.0)}


def test_hybrid_falls_back(spark):
    own = spark.createDataFrame([(1, 1, -0.2), (2, 0, 0.3)], "hour int, prediction int, anomaly_score double")
    other = spark.createDataFrame(
        [(1, 0, 0.4, "normal")], "hour int, supervised_prediction int, supervised_score double, supervised_label string"
    )
    got = {r["hour"]: r for r in rollups.hybrid_hours(own, other).collect()}
    assert (got[1]["final_prediction"], got[1]["ensemble_confidence"], got[1]["final_score"]) == (0, 0.5, 0.4)
    assert (got[2]["final_prediction"], got[2]["ensemble_confidence"], got[2]["final_score"]) == (0, 0.0, 0.3)


def test_hourly_predictions_cut_is_exclusive(spark):
    rows = [(T0, 1, 0.9), (T0, 0, 0.1), (T0 + timedelta(hours=1), 1, 0.8)]
    df = spark.createDataFrame(rows, "t timestamp, prediction int, anomaly_score double")
    got = rollups.hourly_predictions(df, "t").orderBy("hour").collect()
    assert [r["supervised_prediction"] for r in got] == [0, 1]
    assert got[0]["supervised_score"] == pytest.approx(0.5)


SESSION = "id long, srcIP string, dstIP string, srcPort int, dstPort int, TSesStart timestamp, SessDuration double, PktPerSesIn int, PktPerSesOut int, BPerSesIn int, BPerSesOut int"
PREDICTION = "session_id long, model_type string, prediction int, anomaly_score double, traffic_type string, is_anomaly int, log_time timestamp"


def test_session_scored_twice_counts_once(spark):
    sessions = spark.createDataFrame(
        [(1, "a", "b", 1, 2, T0, 5.0, 1, 2, 10, 20), (2, "a", "b", 1, 2, T0, 15.0, 3, 4, 30, 40)], SESSION
    )
    late = T0 + timedelta(days=1)
    preds = spark.createDataFrame(
        [
            (1, "isolation_forest", 1, -0.1, "anomaly", 1, T0),
            (1, "isolation_forest", 0, 0.1, "normal", 0, late),
            (1, "random_forest", 1, -0.6, "anomaly", 1, T0),
            (9, "isolation_forest", 1, -0.1, "anomaly", 1, T0),
        ],
        PREDICTION,
    )
    views = register_views(sessions, preds, prefix="test_")
    hour = views["traffic_summary"].collect()
    assert len(hour) == 1
    assert (hour[0]["session_count"], hour[0]["total_packets"], hour[0]["total_bytes"]) == (2, 10, 100)
    assert (hour[0]["anomaly_count"], hour[0]["anomaly_percentage"]) == (0, 0.0)
    bad = views["anomaly_analysis"].collect()
    assert [(r["id"], r["model_type"], r["risk_level"]) for r in bad] == [(1, "random_forest", "High Risk")]
    stats = spark.table("test_session_stats").collect()
    assert [(r["session_count"], r["avg_duration_seconds"]) for r in stats] == [(2, 10.0)]


def test_orphans_and_reconcile(spark):
    preds = spark.createDataFrame([(1,), (2,), (2,)], "session_id int")
    sessions = spark.createDataFrame([(1,), (3,)], "id int")
    assert [r[0] for r in quality.orphans(preds, sessions, "session_id", "id").collect()] == [2, 2]
    assert tuple(quality.reconcile_counts(sessions, preds).first()) == (2, 3, False)


def test_labels_by_time_does_not_multiply_rows(spark):
    t = spark.createDataFrame([(1, T0), (2, T0), (3, T0 + timedelta(1))], "id int, timestamp timestamp")
    labels = spark.createDataFrame([(T0, 0), (T0, 1)], "timestamp timestamp, prediction int")
    got = quality.labels_by_time(t, labels).collect()
    assert sorted((r["id"], r["prediction"]) for r in got) == [(1, 1), (2, 1)]
