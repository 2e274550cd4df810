"""Codes, distinct counts and reports that are kept up to date load by load."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trafficlens.operators import encoding, rollups
from trafficlens.plans import kept_reports
from trafficlens.plans.views import register_views
from trafficlens.sources import batches

START = datetime(2024, 5, 1)
SESSIONS = ("id long, srcIP string, dstIP string, srcPort int, dstPort int, TSesStart timestamp_ntz, "
            "SessDuration double, PktPerSesIn long, PktPerSesOut long, BPerSesIn double, BPerSesOut double")
SCORES = "session_id long, model_type string, prediction int, anomaly_score double, traffic_type string, is_anomaly int, log_time timestamp_ntz"


def codes_of(df):
    return {r["value"]: r["code"] for r in df.collect()}


def test_codes_grow_and_stay(spark, tmp_path):
    path = str(tmp_path)
    loads = [["c", "a", None, "a"], ["b", "a", "d", ""], [], ["a", None], ["aa"]]
    for k, values in enumerate(loads, 1):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        assert encoding.extend_codes(df, path, k, "x")
        assert not encoding.extend_codes(df, path, k, "x")
    assert codes_of(encoding.read_codes(spark, path, 1)) == {"a": 0, "c": 1}
    last = {"a": 0, "c": 1, "": 2, "b": 3, "d": 4}
    assert codes_of(encoding.read_codes(spark, path, 4)) == last
    assert codes_of(encoding.read_codes(spark, path)) == last | {"aa": 5}
    assert {r["value"]: r["frequency"] for r in encoding.read_codes(spark, path).collect()} == {"a": 4, "c": 1, "": 1, "b": 1, "d": 1, "aa": 1}
    rows = encoding.apply_encoder(spark.createDataFrame([("a",), ("new",), (None,)], "x string"), encoding.read_codes(spark, path), "x")
    assert sorted(((r["x"], r["x_encoded"]) for r in rows.collect()), key=repr) == sorted([("a", 0), ("new", 6), (None, None)], key=repr)


def test_versions_come_in_order_and_failures_leave_nothing(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path), spark.createDataFrame([("a",), ("b",)], "x string")
    with pytest.raises(ValueError):
        encoding.extend_codes(df, path, 2, "x")
    with pytest.raises(ValueError):
        encoding.read_codes(spark, path)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(batches, "commit", fail)
        with pytest.raises(OSError):
            encoding.extend_codes(df, path, 1, "x")
    assert encoding.extend_codes(df.filter("x = 'b'"), path, 1, "x")
    assert codes_of(encoding.read_codes(spark, path)) == {"b": 0}


def test_sketches_of_parts_add_up(spark):
    n = 60_000
    df = spark.range(n).select(
        (F.lit(START).cast("timestamp_ntz") + F.make_interval(secs=F.col("id") * 7)).alias("t"),
        (F.col("id") * 31 % 20_011).alias("a"), F.when(F.col("id") % 5 != 0, (F.col("id") % 17).cast("string")).alias("b"))
    whole = rollups.hourly_sketches(df, "t", "a", "b")
    parts = rollups.hourly_sketches(df.filter("id % 2 = 0"), "t", "a", "b").unionByName(rollups.hourly_sketches(df.filter("id % 2 = 1"), "t", "a", "b"))
    for unit in ("hour", "day", "month"):
        one, two = (sorted(rollups.sketch_counts(rollups.merge_sketches(x, unit)).collect()) for x in (whole, parts))
        assert len(one) == len(two) and [r["row_count"] for r in one] == [r["row_count"] for r in two]
        for x, y in zip(one, two):
            assert x["unique_dests"] == y["unique_dests"] == 17
            assert abs(x["unique_sources"] - y["unique_sources"]) <= 0.01 * x["unique_sources"]
    exact = {r["d"]: r["n"] for r in df.groupBy(F.date_trunc("day", "t").alias("d")).agg(F.count_distinct("a").alias("n")).collect()}
    for r in rollups.sketch_counts(rollups.merge_sketches(parts)).collect():
        assert abs(r["unique_sources"] - exact[r["day"]]) <= 0.02 * exact[r["day"]]


def test_sketches_of_missing_values(spark):
    rows = [(START, None, "x"), (None, "a", "x"), (START, None, "y")]
    hours = rollups.hourly_sketches(spark.createDataFrame(rows, "t timestamp_ntz, a string, b string"), "t", "a", "b")
    assert [tuple(r) for r in rollups.sketch_counts(rollups.merge_sketches(hours)).collect()] == [(START, 2, 0, 2)]
    assert rollups.hourly_sketches(spark.createDataFrame([], "t timestamp_ntz, a string, b string"), "t", "a", "b").count() == 0


def session_rows(r, ids):
    out = []
    for i in ids:
        number = r.choice([1.0, 2.5, float("nan"), float("inf"), None])
        out.append((i, r.choice("ab"), r.choice(["x", None]), 0, r.choice([80, 443]), START + timedelta(minutes=r.randrange(300)) if r.random() > 0.05 else None,
                    number, r.randrange(9), r.choice([None, 3]), 4.0, number))
    return out


def score_rows(r, ids):
    rows = []
    for i in ids:
        p = r.randrange(2)
        rows.append((i, r.choice(["isolation_forest"] * 4 + ["random_forest"]), p, 0.1, "t", p, START + timedelta(hours=r.randrange(4)) if r.random() > 0.2 else None))
    return rows


def whole(rows):
    return sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows], key=repr)


@pytest.mark.parametrize("order", ["spsp", "ppss", "sspp"])
def test_kept_reports_equal_the_views(spark, tmp_path, order):
    r, root = random.Random(order), str(tmp_path)
    loads = {"s": [session_rows(r, [*range(40), 7, None]), session_rows(r, range(40, 80))],
             "p": [score_rows(r, [*range(60), *range(30), None, 999]), score_rows(r, [*range(20, 90), 25, 25])]}
    sessions = spark.createDataFrame(loads["s"][0] + loads["s"][1], SESSIONS)
    scores = spark.createDataFrame(loads["p"][0] + loads["p"][1], SCORES)
    todo = {k: list(v) for k, v in loads.items()}
    for k, kind in enumerate(order):
        rows = todo[kind].pop(0)
        if kind == "s":
            frame, add = spark.createDataFrame(rows, SESSIONS), kept_reports.add_sessions
        else:
            frame, add = spark.createDataFrame(rows, SCORES), kept_reports.add_scores
        assert add(frame, root, f"load-{k}")
        assert not add(frame, root, f"load-{k}")
    views = register_views(sessions, scores, prefix=f"kept_{order}_")
    for name, kept in (("traffic_summary", kept_reports.traffic_summary), ("session_stats", kept_reports.session_stats)):
        got = kept(spark, root)
        assert got.columns == views[name].columns
        assert whole(got.collect()) == whole(views[name].collect())


def test_empty_loads(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        kept_reports.traffic_summary(spark, root)
    kept_reports.add_scores(spark.createDataFrame([], SCORES), root, "a")
    kept_reports.add_sessions(spark.createDataFrame([], SESSIONS), root, "b")
    kept_reports.add_scores(spark.createDataFrame([], SCORES), root, "c")
    assert kept_reports.traffic_summary(spark, root).count() == kept_reports.session_stats(spark, root).count() == 0
