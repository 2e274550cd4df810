"""NaN, infinities and missing times count as missing everywhere."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import correlation, encoding, features, iforest, ordering, quality, rollups, rules, wide
from trafficlens.plans.views import register_views

T0 = datetime(2025, 12, 10)
NAN, INF = float("nan"), float("inf")


def dirty(spark):
    rows = [(i, T0 + timedelta(minutes=i), float(i % 5)) for i in range(40)]
    rows += [(40, T0, NAN), (41, T0, INF), (42, T0, -INF), (43, None, 1.0), (44, T0, None)]
    return spark.createDataFrame(rows, "id long, timestamp timestamp, packet_size double")


def clean(spark):
    bad = F.isnan("packet_size") | (F.abs("packet_size") == INF)
    return dirty(spark).withColumn("packet_size", F.when(~bad, F.col("packet_size")))


def same(a, b):
    def plain(df):
        return sorted(str(tuple("missing" if v is None or isinstance(v, float) and not math.isfinite(v) else v for v in r)) for r in df.collect())

    return plain(a) == plain(b)


def test_same_as_with_nulls(spark):
    d, c = dirty(spark), clean(spark)
    assert same(rules.zscore_flags(d, ["packet_size"]).select("id", "prediction"), rules.zscore_flags(c, ["packet_size"]).select("id", "prediction"))
    assert same(features.standardize(d, ["packet_size"]), features.standardize(c, ["packet_size"]))
    ends = d.withColumns({"source_ip": F.lit("a"), "dest_ip": F.lit("b")}), c.withColumns({"source_ip": F.lit("a"), "dest_ip": F.lit("b")})
    assert same(*[rollups.hourly_features(x) for x in ends])
    for act in (
        lambda x: rollups.hourly_metrics(x, "timestamp", ["packet_size"]),
        lambda x: rollups.hourly_resample(x, "timestamp", "packet_size"),
        lambda x: rollups.histogram(x, "packet_size", 5),
        lambda x: quality.numeric_profile(x),
        lambda x: correlation.correlation_long(x, ["packet_size", "id"]),
    ):
        assert same(act(d), act(c))


def test_rule_labels_ignore_nan_sizes(spark):
    rows = [(1, "a", T0, NAN), (2, "a", T0 + timedelta(hours=1), 100.0), (3, "a", None, 9000.0), (4, None, T0, 10.0)]
    df = spark.createDataFrame(rows, "id long, source_ip string, timestamp timestamp, packet_size double")
    got = {r["id"]: (r["anomaly_flag"], r["diff_seconds"]) for r in rules.rule_labels(df).collect()}
    assert got == {1: (0, 0.0), 2: (0, 3600.0), 3: (1, 0.0), 4: (1, 0.0)}


def test_rows_without_time_or_source_are_spread(spark):
    df = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 'hot', null) source", "cast(null as timestamp) t")
    plan = rules.interarrival(df, "source", "t", "id")
    groups = plan.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert plan.count() == 4000 and max(r["count"] for r in groups) < 3000


@pytest.mark.parametrize("values", [
    [1.0, 2.0, INF], [-INF, INF, 0.0, 1.0], [1e308, -1e308, 0.0, 5e-324, 1e-300, -1e-300], [2.0**k for k in range(-300, 300, 7)],
    [3.0] * 50 + [NAN], [-INF] * 5, np.random.default_rng(1).normal(size=500).tolist(), [1e300, 1e300 * (1 + 2**-52)] * 9,
])
def test_quantiles_end_and_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    kept = np.sort([v for v in values if not math.isnan(v)])
    for p in (0.0, 0.1, 0.5, 0.9, 1.0):
        at = p * (len(kept) - 1)
        low, high, part = kept[int(at)], kept[min(int(at) + 1, len(kept) - 1)], at - int(at)
        got = ordering.exact_quantiles(df, "x", [p])[0]
        if low == high or not part:
            assert got == low
        elif math.isinf(low) or math.isinf(high):
            want = low * (1 - part) + high * part
            assert got == want or math.isnan(got) and math.isnan(want)
        else:
            assert got == pytest.approx(low + part * (high - low), rel=1e-12)


def test_detectors_take_infinities_as_missing(spark):
    df = dirty(spark).withColumn("y", F.col("id") % 3)
    assert iforest.detect(df, "id", ["packet_size", "y"], trees=5)[0].count() == 45
    stats = wide.feature_stats(df, ["packet_size"])
    assert stats.mean[0] == pytest.approx(np.mean([i % 5 for i in range(40)] + [1.0]))


def test_narrow_and_wide_correlation_agree(spark, monkeypatch):
    rows = [(1e9 + (1e-4 if i % 2 else -1e-4), float(i % 2), float(i), NAN if i == 3 else 5.0, 7.0) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    names = df.columns
    monkeypatch.setattr(correlation, "PAIRWISE_LIMIT", len(names))
    narrow = {(r[0], r[1]): r[2] for r in correlation.correlation_long(df, names).collect()}
    monkeypatch.setattr(correlation, "PAIRWISE_LIMIT", 2)
    for r in correlation.correlation_long(df, names).collect():
        want = narrow[r[0], r[1]]
        assert (want is None) == (r[2] is None)
        assert want is None or r[2] == pytest.approx(want, abs=1e-4)


def test_predictions_without_a_time_are_in_all_views(spark):
    sessions = spark.createDataFrame(
        [(i, "a", "b", 1, 2, T0, 5.0, 1.0, 1.0, 1.0, 1.0) for i in range(3)],
        "id long, srcIP string, dstIP string, srcPort int, dstPort int, TSesStart timestamp, SessDuration double, "
        "PktPerSesIn double, PktPerSesOut double, BPerSesIn double, BPerSesOut double")
    preds = spark.createDataFrame(
        [(0, "isolation_forest", 1, -0.7, "anomaly", 1, None), (1, "isolation_forest", 1, -0.2, "anomaly", 1, None), (1, "isolation_forest", 0, 0.2, "normal", 0, T0)],
        "session_id long, model_type string, prediction int, anomaly_score double, traffic_type string, is_anomaly int, log_time timestamp")
    views = register_views(sessions, preds, prefix="dirty_")
    assert views["traffic_summary"].first()["anomaly_count"] == 1
    assert views["session_stats"].first()["anomaly_sessions"] == 1
    assert [(r["id"], r["risk_level"]) for r in views["anomaly_analysis"].collect()] == [(0, "High Risk")]


def test_encoder_reads_its_input_once(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('v', id)) a", "if(id % 5 = 0, null, concat('w', id % 900)) b", "'c' c").write.parquet(path)
    df = spark.read.parquet(path)
    encoders = {c: encoding.fit_encoder(df, c) for c in "abc"}
    small = {c: {r[0]: r[1] for r in encoding.apply_encoder(df, encoders[c], c).select(c, f"{c}_encoded").collect()} for c in "abc"}
    monkeypatch.setattr(encoding, "broadcast_if_small", lambda x: x)
    out = df
    for c in "abc":
        out = encoding.apply_encoder(out, encoders[c], c)
    assert out.count() == 3000
    assert {c: {r[0]: r[1] for r in out.select(c, f"{c}_encoded").collect()} for c in "abc"} == small
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [id") == 1
