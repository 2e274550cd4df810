from __future__ import annotations

from datetime import datetime

import pytest

from trafficlens.operators import cleaning, wide
from trafficlens.operators.features import anonymize, preprocess, session_features, standardize
from trafficlens.sources import schemas


def column(df, name, key="id"):
    return [r[name] for r in df.orderBy(key).collect()]


def test_fill_by_type(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, 5.0, "a", None)], "id int, x double, s string, t timestamp")
    filled = cleaning.fill_by_type(df)
    assert column(filled, "x") == [0.0, 5.0]
    assert column(filled, "s") == ["unknown", "a"]
    assert column(filled, "t") == [None, None]
    timed = cleaning.fill_by_type(df, fill_times=True).selectExpr("id", "cast(t as string) t")
    assert column(timed, "t") == ["1970-01-01 00:00:00"] * 2


def test_impute_mean(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None), (2, None, None), (3, float("nan"), None), (4, 5.0, None)], "id int, x double, y double"
    )
    filled = cleaning.impute_mean(df, ["x", "y"])
    assert column(filled, "x") == [1.0, 3.0, 3.0, 5.0]
    assert column(filled, "y") == [None] * 4


def test_impute_mode_ties_and_all_null(spark):
    rows = [(1, "b", None), (2, "a", None), (3, "b", None), (4, "a", None), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, s string, z string")
    filled = cleaning.impute_mode(df, ["s", "z"])
    assert column(filled, "s")[-1] == "a"
    assert column(filled, "z") == ["unknown"] * 5


def test_clean_rows(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (1, 1.0), (2, None), (3, float("nan")), (4, 2.0)], "id int, x double"
    )
    assert sorted(tuple(r) for r in cleaning.clean_rows(df).collect()) == [(1, 1.0), (4, 2.0)]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, float("nan"), None), (3, 1.0, None)], "id int, x double, s string")
    got = {r["column_name"]: r["null_count"] for r in cleaning.null_counts(df).collect()}
    assert got == {"id": 0, "x": 2, "s": 2}


def test_flags_to_int(spark):
    df = cleaning.flags_to_int(spark.createDataFrame([(1, True), (2, None)], "id int, f boolean"))
    assert column(df, "f") == [1, None]


def test_standardize_population_and_constant(spark):
    df = spark.createDataFrame([(i, x, 7.0) for i, x in enumerate([1.0, 2.0, 3.0, 6.0])], "id int, x double, c double")
    got = standardize(df, ["x", "c"])
    spread = 3.5**0.5  # population variance of 1, 2, 3, 6
    assert column(got, "x") == pytest.approx([(v - 3) / spread for v in (1, 2, 3, 6)])
    assert column(got, "c") == [0.0] * 4


def test_standardize_empty(spark):
    df = spark.createDataFrame([], "id int, x double")
    assert standardize(df, ["x"]).collect() == []


def test_wide_and_narrow_stats_agree(spark, monkeypatch):
    rows = [(1.0, None, 4.0), (2.0, 3.0, 4.0), (6.0, float("nan"), 4.0), (7.0, 9.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    narrow = wide.feature_stats(df, ["a", "b", "c"])
    monkeypatch.setattr(wide, "NARROW_LIMIT", 1)
    broad = wide.feature_stats(df, ["a", "b", "c"])
    assert narrow.mean == pytest.approx([4.0, 6.0, 4.0])
    assert broad.mean == pytest.approx(narrow.mean)
    assert broad.std == pytest.approx(narrow.std)
    # b after imputation: 6, 3, 6, 9
    assert narrow.std[1] == pytest.approx((18 / 4) ** 0.5)
    assert broad.rows == narrow.rows == 4


def test_wide_table_of_many_columns(spark):
    names = [f"f{i}" for i in range(150)]
    df = spark.range(20).selectExpr("id", *[f"cast(id * {i} as double) as {n}" for i, n in enumerate(names)])
    stats = wide.feature_stats(df, names)
    assert stats.mean[3] == pytest.approx(3 * 9.5)
    scaled = df.select(wide.scaled_vector(stats).alias("v")).collect()
    assert sum(r["v"][5] for r in scaled) == pytest.approx(0.0, abs=1e-9)
    assert [r["v"][0] for r in scaled] == [0.0] * 20


def test_session_features(spark):
    a, b = datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 0, 10)
    df = spark.createDataFrame(
        [(1, a, b, 5, 15, 100.0), (2, a, a, 5, 15, 100.0), (3, a, None, 5, 15, 100.0)],
        "id int, s timestamp, e timestamp, i int, o int, b double",
    )
    got = session_features(df, "s", "e", "i", "o", "b")
    assert column(got, "session_duration") == [10.0, 0.0, None]
    assert column(got, "packet_rate") == [2.0, 20.0, None]
    assert column(got, "bytes_per_session") == [10.0, 100.0, None]
    with pytest.raises(ValueError, match="missing columns: e"):
        session_features(df.drop("e"), "s", "e")


def test_anonymize_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1, "x")], "id int, source_ip string")
    assert len(anonymize(df, ["source_ip", "nowhere"]).first()["source_ip"]) == 64


def test_preprocess(spark):
    t = datetime(2025, 12, 8, 5)
    rows = [
        (1, t, "10.0.0.1", "GET", 200, 10.0),
        (1, t, "10.0.0.1", "GET", 200, 10.0),
        (2, t, "10.0.0.2", "POST", 500, 30.0),
        (3, t, None, "GET", 200, 10.0),
    ]
    df = spark.createDataFrame(
        rows, "id int, log_time timestamp, source_ip string, request_method string, response_code int, bytes_sent double"
    )
    got = preprocess(df, encode=["request_method"], scale=["bytes_sent"])
    assert got.count() == 2
    assert column(got, "label") == [0, 1]
    assert column(got, "request_method") == [0, 1]
    assert column(got, "bytes_sent") == [-1.0, 1.0]
    assert column(got, "hour") == [5, 5]
    assert "log_time" not in got.columns


def test_names():
    assert schemas.standard_name(" Src-IP (v4) ") == "src_ip__v4_"
    assert schemas.table_safe_name("a<b> c-d") == "a_b__c_d"


def test_colliding_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="collide"):
        schemas.rename_all(df, schemas.standard_name)


def test_awkward_column_names(spark):
    from trafficlens.operators import correlation, iforest, rollups, rules

    name = "Bytes.In<10> [a]"
    df = spark.createDataFrame([(i, float(i) if i else None, datetime(2025, 1, 1)) for i in range(30)], f"id long, `{name}` double, t timestamp")
    assert cleaning.impute_mean(df, [name]).filter("id = 0").first()[name] == 15.0
    assert cleaning.sanitize_numbers(df, [name]).count() == 30
    assert cleaning.impute_mode(df.selectExpr("id", f"cast(`{name}` as string) `{name}`"), [name]).first()[name] == "1.0"
    assert standardize(df, [name]).count() == 30
    assert rules.zscore_flags(df, [name]).filter("statistical_anomaly").count() == 0
    assert rollups.hourly_metrics(df, "t", [name]).first()[f"{name}_count"] == 29
    assert correlation.correlation_long(df, ["id", name]).count() == 4
    assert iforest.detect(df, "id", [name], trees=3)[0].count() == 30
    assert cleaning.null_counts(df, [name]).first()["null_count"] == 1
