from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from trafficlens.functions import columns as fx


def one(spark, column, **values):
    parts = [f"{v} AS {k}" for k, v in values.items()]
    return spark.sql("SELECT " + ", ".join(parts or ["1 AS x"])).select(column.alias("out")).first()["out"]


def test_epoch_to_timestamp(spark):
    df = spark.createDataFrame(
        [("0",), ("1.5",), ("oops",), ("NaN",), ("1e39",), ("",), (None,), ("-1",)], "s string"
    )
    got = [r[0] for r in df.select(fx.epoch_to_timestamp(F.col("s"))).collect()]
    assert got[2] is got[3] is got[4] is got[5] is got[6] is None
    text = [r[0] for r in df.select(fx.epoch_to_timestamp(F.col("s")).cast("string")).collect()]
    assert text[0] == "1970-01-01 00:00:00"
    assert text[1] == "1970-01-01 00:00:01.5"
    assert text[7] == "1969-12-31 23:59:59"


def test_text_to_timestamp(spark):
    df = spark.createDataFrame([("2025-12-10 01:02:03",), ("bad",), (None,)], "s string")
    got = [r[0] for r in df.select(fx.text_to_timestamp(F.col("s")).cast("string")).collect()]
    assert got == ["2025-12-10 01:02:03", None, None]
    fmt = df.select(fx.text_to_timestamp(F.lit("10/12/2025"), "dd/MM/yyyy").cast("string")).first()[0]
    assert fmt == "2025-12-10 00:00:00"


def test_clean_number(spark):
    values = [(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (1e39,), (-1e39,), (1e38,), (None,)]
    df = spark.createDataFrame(values, "v double")
    got = [r[0] for r in df.select(fx.clean_number(F.col("v"))).collect()]
    assert got == [1.0, None, None, None, None, None, 1e38, None]


def test_anonymized_keeps_null(spark):
    df = spark.createDataFrame([("10.0.0.1",), (None,)], "ip string")
    got = [r[0] for r in df.select(fx.anonymized(F.col("ip"))).collect()]
    assert got == [hashlib.sha256(b"10.0.0.1").hexdigest(), None]


def test_flags_and_labels(spark):
    df = spark.createDataFrame([(399, "normal"), (400, "anomaly"), (None, "other")], "code int, label string")
    rows = df.select(fx.status_flag(F.col("code")).alias("a"), fx.text_flag(F.col("label")).alias("b")).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (1, 1), (0, None)]


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(-0.51,), (-0.5,), (-0.01,), (0.0,), (None,)], "s double")
    got = [r[0] for r in df.select(fx.risk_band(F.col("s"))).collect()]
    assert got == ["High Risk", "Medium Risk", "Medium Risk", "Low Risk", "Low Risk"]


def test_confidence(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2)], "p int, q double")
    got = [round(r[0], 6) for r in df.select(fx.binary_confidence(F.col("p"), F.col("q"))).collect()]
    assert got == [0.9, 0.8]


def test_rates_and_percent(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 5.0), (10.0, None)], "a double, d double")
    assert [r[0] for r in df.select(fx.per_second(F.col("a"), F.col("d"))).collect()] == [10.0, 2.0, None]
    assert one(spark, fx.percent(F.lit(1), F.lit(3), 2)) == 33.33
    assert one(spark, fx.percent(F.lit(0), F.lit(0))) == 0.0
    assert one(spark, fx.ratio(F.lit(1), F.lit(0))) == 0.0


def test_calendar_monday_is_zero(spark):
    df = spark.createDataFrame([(datetime(2025, 12, 8, 23, 5),), (datetime(2025, 12, 14),)], "t timestamp")
    rows = df.select(*[c.alias(n) for n, c in fx.calendar_columns(F.col("t")).items()]).collect()
    assert tuple(rows[0]) == (23, 0, 12, 8)
    assert rows[1]["day_of_week"] == 6


def test_hour_attributes(spark):
    assert one(spark, fx.hour_packet_size(F.lit(23))) == 2391
    assert one(spark, fx.hour_packet_size(F.lit(0))) == 2000
    assert one(spark, fx.hour_source_ip(F.lit(7))) == "192.168.7.1"
    assert one(spark, fx.hour_dest_ip(F.lit(7))) == "192.168.8.2"
    assert one(spark, fx.hour_dest_ip(F.lit(255))) == "192.168.0.2"


def test_hash_bucket_known_value(spark):
    digest = hashlib.md5(b"7|42").hexdigest()[:8]
    assert one(spark, fx.hash_bucket(F.lit(7), 42)) == int(digest, 16) % 100
