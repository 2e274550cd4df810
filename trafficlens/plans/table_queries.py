"""Scans, cleaning, projection and feature queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions import columns as fx
from trafficlens.operators import cleaning, encoding, features, quality, sampling
from trafficlens.plans import tables
from trafficlens.plans.registry import (
    PREDS,
    RESULTS,
    TRAFFIC,
    query,
    rounded,
    with_ctes,
)
from trafficlens.session import work_dir
from trafficlens.sources import readers, writers

_T = with_ctes(TRAFFIC)


@query("traffic_scan", _T + "SELECT id, log_time, source_id, traffic_type, packet_size FROM traffic")
def traffic_scan(spark, folder):
    return tables.traffic(spark, folder).select("id", "log_time", "source_id", "traffic_type", "packet_size")


@query(
    "incremental_scan",
    with_ctes(TRAFFIC, PREDS)
    + """SELECT id, log_time, source_id, packet_size FROM traffic
WHERE log_time > coalesce((SELECT max(log_time) FROM preds WHERE anomaly_score < -2.2),
                          TIMESTAMP '2024-01-01 00:00:00')""",
)
def incremental_scan(spark, folder):
    """Rows newer than the newest strongly anomalous prediction."""
    processed = tables.predictions(spark, folder).filter("anomaly_score < -2.2")
    mark = readers.high_water_mark(processed, "log_time", "2024-01-01 00:00:00")
    new = readers.rows_after(tables.traffic(spark, folder), "log_time", mark)
    return new.select("id", "log_time", "source_id", "packet_size")


@query("wide_csv_scan", _T + "SELECT id, log_time AS \"TSesStart\", traffic_type AS label_2, packet_size AS \"BPerSesIn\" FROM traffic")
def wide_csv_scan(spark, folder):
    """The traffic as semicolon CSV with epoch seconds, read back with a frozen schema."""
    path = f"{work_dir(spark)}/wide-csv-{uuid.uuid4().hex}"
    seconds = (F.unix_micros(F.col("log_time").cast("timestamp")).cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)")
    rows = tables.traffic(spark, folder).select(
        "id", seconds.alias("TSesStart"), F.col("traffic_type").alias("label_2"), F.col("packet_size").alias("BPerSesIn")
    )
    writers.export_csv(rows, path, sep=";")
    schema = T.StructType.fromDDL("id long, TSesStart double, label_2 string, BPerSesIn double")
    good, _ = readers.split_bad_records(readers.read_wide_csv(spark, path, schema))
    return good.withColumn("TSesStart", F.col("TSesStart").cast("timestamp_ntz"))


@query(
    "conform_layout",
    _T
    + """SELECT log_time AS "timestamp", source_id::VARCHAR AS src_ip, '0.0.0.0' AS dst_ip, 0 AS source_port,
       0 AS destination_port, 'HTTP' AS protocol, k::BIGINT AS packet_size, 0.0::DOUBLE AS duration,
       'normal' AS label FROM traffic""",
)
def conform_layout(spark, folder):
    target = T.StructType.fromDDL(
        "timestamp timestamp_ntz, src_ip string, dst_ip string, source_port int, destination_port int, "
        "protocol string, packet_size long, duration double, label string"
    )
    mapping = {
        "timestamp": "log_time",
        "src_ip": "source_id",
        "dst_ip": F.lit("0.0.0.0"),
        "source_port": F.lit(0),
        "destination_port": F.lit(0),
        "protocol": F.lit("HTTP"),
        "packet_size": "k",
        "duration": F.lit(0.0),
        "label": F.lit("normal"),
    }
    return readers.conform(tables.traffic(spark, folder), mapping, target)


def _profile_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count({c}) AS value_count, round(avg({c}), 9) AS mean_value, "
        f"round(min({c})::DOUBLE, 9) AS min_value, round(max({c})::DOUBLE, 9) AS max_value FROM customer"
        for c in ("c_nationkey", "c_acctbal")
    ]
    return " UNION ALL ".join(parts)


@query("numeric_profile", _profile_sql())
def numeric_profile(spark, folder):
    return rounded(quality.numeric_profile(tables.table(spark, folder, "customer"), exclude=("c_custkey",)))


@query(
    "frame_profile",
    """SELECT count(*) AS row_count, 5 AS column_count,
       'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS column_names FROM customer""",
)
def frame_profile(spark, folder):
    return quality.frame_profile(tables.table(spark, folder, "customer"))


@query(
    "sanitize_numeric",
    _T
    + """SELECT id, CASE WHEN traffic_type IN ('error', 'signup', 'view') THEN NULL ELSE packet_size END AS packet_size
FROM traffic""",
)
def sanitize_numeric(spark, folder):
    """Errors become NaN, signups infinite and views oversized; all three are not storable."""
    kind = F.col("traffic_type")
    spoiled = (
        F.when(kind == "error", F.lit(float("nan")))
        .when(kind == "signup", F.lit(float("-inf")))
        .when(kind == "view", F.lit(1e39))
        .otherwise(F.col("packet_size"))
    )
    t = tables.traffic(spark, folder).withColumn("packet_size", spoiled)
    return cleaning.sanitize_numbers(t, ["packet_size"]).select("id", "packet_size")


@query(
    "epoch_to_ts",
    """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS log_time
FROM events""",
)
def epoch_to_ts(spark, folder):
    """Epoch seconds as text, unreadable for errors, back to timestamps."""
    e = tables.table(spark, folder, "events")
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("string")
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(seconds)
    return e.select(
        F.col("event_id").alias("id"), fx.epoch_to_timestamp(text).cast("timestamp_ntz").alias("log_time")
    )


@query(
    "text_to_ts",
    """SELECT event_id AS id, date_trunc('second', ts) AS log_time FROM events WHERE event_type <> 'error'""",
)
def text_to_ts(spark, folder):
    """Timestamps as text, unreadable for errors; unreadable rows are dropped."""
    e = tables.table(spark, folder, "events")
    text = F.when(F.col("event_type") == "error", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    parsed = fx.text_to_timestamp(text).cast("timestamp_ntz")
    return e.select(F.col("event_id").alias("id"), parsed.alias("log_time")).filter("log_time IS NOT NULL")


_GAPPY = """gappy AS (
  SELECT id, CASE WHEN traffic_type = 'error' THEN NULL ELSE packet_size END AS packet_size,
         CASE WHEN traffic_type = 'error' THEN NULL ELSE k END AS k,
         CASE WHEN packet_size > 80 THEN NULL ELSE traffic_type END AS traffic_type FROM traffic)"""


def _gappy(spark, folder):
    t = tables.traffic(spark, folder)
    error = F.col("traffic_type") == "error"
    return t.select(
        "id",
        F.when(~error, F.col("packet_size")).alias("packet_size"),
        F.when(~error, F.col("k")).alias("k"),
        F.when(F.col("packet_size") <= 80, F.col("traffic_type")).alias("traffic_type"),
    )


@query(
    "fill_by_type",
    with_ctes(TRAFFIC, _GAPPY)
    + """SELECT id, coalesce(packet_size, 0) AS packet_size, coalesce(k, 0) AS k,
       coalesce(traffic_type, 'unknown') AS traffic_type FROM gappy""",
)
def fill_by_type(spark, folder):
    return cleaning.fill_by_type(_gappy(spark, folder))


@query(
    "impute_mean",
    with_ctes(TRAFFIC, _GAPPY)
    + """SELECT id, round(coalesce(packet_size, (SELECT avg(packet_size) FROM gappy)), 9) AS packet_size,
       round(coalesce(k, (SELECT avg(k) FROM gappy)), 9) AS k FROM gappy""",
)
def impute_mean(spark, folder):
    return rounded(cleaning.impute_mean(_gappy(spark, folder).select("id", "packet_size", "k"), ["packet_size", "k"]))


@query(
    "impute_mode",
    with_ctes(TRAFFIC, _GAPPY)
    + """SELECT id, coalesce(traffic_type, (SELECT traffic_type FROM gappy WHERE traffic_type IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, traffic_type LIMIT 1)) AS traffic_type FROM gappy""",
)
def impute_mode(spark, folder):
    return cleaning.impute_mode(_gappy(spark, folder).select("id", "traffic_type"), ["traffic_type"])


@query(
    "clean_rows",
    with_ctes(TRAFFIC, _GAPPY) + "SELECT DISTINCT k, traffic_type FROM gappy WHERE k IS NOT NULL AND traffic_type IS NOT NULL",
)
def clean_rows(spark, folder):
    return cleaning.clean_rows(_gappy(spark, folder).select("k", "traffic_type"))


@query(
    "null_audit",
    with_ctes(TRAFFIC, _GAPPY)
    + """SELECT 'id' AS column_name, count(*) - count(id) AS null_count FROM gappy
UNION ALL SELECT 'packet_size', count(*) - count(packet_size) FROM gappy
UNION ALL SELECT 'k', count(*) - count(k) FROM gappy
UNION ALL SELECT 'traffic_type', count(*) - count(traffic_type) FROM gappy""",
)
def null_audit(spark, folder):
    return cleaning.null_counts(_gappy(spark, folder))


@query(
    "session_features",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, d AS session_duration,
  (l_quantity + l_linenumber) / CASE WHEN d = 0 THEN 1 ELSE d END AS packet_rate,
  l_extendedprice / CASE WHEN d = 0 THEN 1 ELSE d END AS bytes_per_session
FROM (SELECT *, (epoch_us(l_shipdate) - epoch_us(o_orderdate))::DOUBLE / 1000000 AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)
def session_features(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    made = features.session_features(
        joined, "o_orderdate", "l_shipdate", "l_quantity", "l_linenumber", "l_extendedprice"
    )
    return made.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "session_duration", "packet_rate", "bytes_per_session",
    )


@query(
    "calendar_features",
    _T
    + """SELECT id, hour(log_time)::INT AS hour, (isodow(log_time) - 1)::INT AS day_of_week,
       month(log_time)::INT AS month, day(log_time)::INT AS day FROM traffic""",
)
def calendar_features(spark, folder):
    t = tables.traffic(spark, folder).select("id", "log_time")
    return features.calendar_features(t, "log_time").drop("log_time")


@query(
    "anonymize",
    "SELECT c_custkey, sha256(c_name) AS c_name, sha256(c_nationkey::VARCHAR) AS c_nationkey FROM customer",
)
def anonymize(spark, folder):
    c = tables.table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    return features.anonymize(c, ["c_name", "c_nationkey", "absent_column"])


@query(
    "status_label",
    _T + "SELECT id, 350 + k AS response_code, CASE WHEN 350 + k >= 400 THEN 1 ELSE 0 END AS label FROM traffic",
)
def status_label(spark, folder):
    t = tables.traffic(spark, folder).select("id", (F.lit(350) + F.col("k")).alias("response_code"))
    return features.status_label(t)


@query(
    "risk_bands",
    with_ctes(TRAFFIC, PREDS)
    + """SELECT session_id, model_type,
  CASE WHEN anomaly_score < -0.5 THEN 'High Risk' WHEN anomaly_score < 0 THEN 'Medium Risk' ELSE 'Low Risk' END
    AS risk_level,
  CASE WHEN prediction = 1 THEN 'anomaly' ELSE 'normal' END AS traffic_type,
  CASE WHEN anomaly_score < 0 THEN 1 ELSE 0 END AS score_flag,
  round(-anomaly_score, 9) AS severity FROM preds""",
)
def risk_bands(spark, folder):
    p = tables.predictions(spark, folder)
    score = F.col("anomaly_score")
    made = p.select(
        "session_id",
        "model_type",
        fx.risk_band(score).alias("risk_level"),
        fx.traffic_label(F.col("prediction")).alias("traffic_type"),
        fx.score_flag(score).alias("score_flag"),
        fx.severity(score).alias("severity"),
    )
    return rounded(made)


@query(
    "score_series",
    with_ctes(TRAFFIC, RESULTS)
    + """SELECT log_time, round(anomaly_score, 9) AS anomaly_score,
       CASE WHEN anomaly_score < 0 THEN 'red' ELSE 'blue' END AS colour FROM results ORDER BY log_time""",
)
def score_series(spark, folder):
    r = tables.results(spark, folder)
    series = r.select("log_time", "anomaly_score", fx.point_colour(F.col("anomaly_score")).alias("colour"))
    return rounded(series).orderBy("log_time")


@query(
    "hour_attributes",
    """SELECT event_id AS id, 2000 + (hour(ts)::INT * 17) % 2000 AS packet_size,
       '192.168.' || (hour(ts) % 256)::VARCHAR || '.1' AS source_ip,
       '192.168.' || ((hour(ts) + 1) % 256)::VARCHAR || '.2' AS dest_ip FROM events""",
)
def hour_attributes(spark, folder):
    t = tables.traffic(spark, folder).select("id", "log_time")
    return features.hour_attributes(t, "log_time").drop("log_time")


@query(
    "standardize",
    _T
    + """SELECT id, round((packet_size - avg(packet_size) OVER ()) / stddev_pop(packet_size) OVER (), 6) AS packet_size,
       round((k - avg(k) OVER ()) / stddev_pop(k) OVER (), 6) AS k FROM traffic""",
)
def standardize(spark, folder):
    t = tables.traffic(spark, folder).select("id", "packet_size", "k")
    return rounded(features.standardize(t, ["packet_size", "k"]), 6)


@query(
    "label_encode",
    """SELECT o_orderkey, o_orderpriority, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::BIGINT AS priority_code
FROM orders""",
)
def label_encode(spark, folder):
    o = tables.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return encoding.label_encode(o, "o_orderpriority", "priority_code")


@query(
    "encode_endpoints",
    """WITH v AS (SELECT l_suppkey::VARCHAR AS value FROM lineitem UNION SELECT l_partkey::VARCHAR FROM lineitem),
codes AS (SELECT value, (row_number() OVER (ORDER BY value) - 1)::BIGINT AS code FROM v)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a.code AS source_code, b.code AS dest_code
FROM lineitem JOIN codes a ON a.value = l_suppkey::VARCHAR JOIN codes b ON b.value = l_partkey::VARCHAR""",
)
def encode_endpoints(spark, folder):
    """One vocabulary over both endpoint columns, so their codes are comparable."""
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    encoder = encoding.fit_encoder(lines, "l_suppkey", "l_partkey")
    coded = encoding.apply_encoder(lines, encoder, "l_suppkey", "source_code")
    return encoding.apply_encoder(coded, encoder, "l_partkey", "dest_code")


@query(
    "endpoint_vocabulary",
    """SELECT value, count(*) AS frequency FROM (SELECT l_suppkey::VARCHAR AS value FROM lineitem
UNION ALL SELECT l_partkey::VARCHAR FROM lineitem) GROUP BY value""",
)
def endpoint_vocabulary(spark, folder):
    return encoding.vocabulary(tables.table(spark, folder, "lineitem"), "l_suppkey", "l_partkey")


@query(
    "preprocess_full",
    """WITH raw AS (
  SELECT DISTINCT ts, sha256(user_id::VARCHAR) AS source_ip, event_type, 350 + (props->>'k')::INT AS response_code,
         value AS bytes_sent FROM events),
made AS (
  SELECT source_ip, (dense_rank() OVER (ORDER BY event_type) - 1)::BIGINT AS request_method,
    CASE WHEN response_code >= 400 THEN 1 ELSE 0 END AS label, response_code, bytes_sent,
    hour(ts)::DOUBLE AS hour, (isodow(ts) - 1)::INT AS day_of_week, month(ts)::INT AS month, day(ts)::INT AS day
  FROM raw)
SELECT source_ip, request_method, label, day_of_week, month, day,
  round((response_code - avg(response_code) OVER ()) / stddev_pop(response_code) OVER (), 6) AS response_code,
  round((bytes_sent - avg(bytes_sent) OVER ()) / stddev_pop(bytes_sent) OVER (), 6) AS bytes_sent,
  round((hour - avg(hour) OVER ()) / stddev_pop(hour) OVER (), 6) AS hour
FROM made""",
)
def preprocess_full(spark, folder):
    t = tables.traffic(spark, folder)
    http = t.select(
        "log_time",
        F.col("source_id").cast("string").alias("source_ip"),
        F.col("traffic_type").alias("request_method"),
        (F.lit(350) + F.col("k")).alias("response_code"),
        F.col("packet_size").alias("bytes_sent"),
    )
    done = features.preprocess(
        http, encode=["request_method"], scale=["response_code", "bytes_sent", "hour"]
    )
    return rounded(done, 6)


@query(
    "hash_split",
    _T
    + """SELECT id, CASE WHEN ('0x' || substr(md5(id::VARCHAR || '|42'), 1, 8))::BIGINT % 100 < 80
       THEN 'train' ELSE 'test' END AS split FROM traffic""",
)
def hash_split(spark, folder):
    return sampling.hash_split(tables.traffic(spark, folder).select("id"), "id")


@query(
    "stratified_split",
    """WITH r AS (SELECT event_id AS id, event_type AS traffic_type,
  row_number() OVER (PARTITION BY event_type
    ORDER BY md5(event_id::VARCHAR || '|42'), event_id) AS place,
  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT id, traffic_type, CASE WHEN place <= floor(n * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def stratified_split(spark, folder):
    return sampling.stratified_split(tables.traffic(spark, folder).select("id", "traffic_type"), "id", "traffic_type")


@query(
    "split_balance",
    """SELECT event_type AS traffic_type, CASE WHEN ('0x' || substr(md5(event_id::VARCHAR || '|42'), 1, 8))::BIGINT % 100 < 80
       THEN 'train' ELSE 'test' END AS split, count(*) AS row_count FROM events GROUP BY ALL""",
)
def split_balance(spark, folder):
    return sampling.split_balance(tables.traffic(spark, folder), "id", "traffic_type")


@query("sample_rows", _T + "SELECT id, log_time, packet_size FROM traffic ORDER BY id LIMIT 5")
def sample_rows(spark, folder):
    return sampling.sample_rows(tables.traffic(spark, folder).select("id", "log_time", "packet_size"), "id", 5)


@query(
    "restamp_hourly",
    """SELECT event_id AS id, TIMESTAMP '2025-12-10 00:00:00'
  + to_hours((row_number() OVER (ORDER BY ts, event_id) - 1)::INT) AS log_time FROM events""",
)
def restamp_hourly(spark, folder):
    t = tables.traffic(spark, folder).select("id", "log_time")
    return sampling.restamp_hourly(t, "log_time", "id", "2025-12-10 00:00:00")


@query(
    "dense_ids",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS session_id, o_orderkey FROM orders""",
)
def dense_ids(spark, folder):
    """Consecutive surrogate ids in time order."""
    from trafficlens.operators.ordering import dense_ids as number

    o = tables.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return number(o, ["o_orderdate", "o_orderkey"], "session_id").drop("o_orderdate")


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables.TABLES),
)
def table_counts(spark, folder):
    return quality.table_counts({t: tables.table(spark, folder, t) for t in tables.TABLES})


@query(
    "reconcile_counts",
    with_ctes(TRAFFIC, PREDS)
    + """SELECT (SELECT count(*) FROM traffic) AS source_rows,
  (SELECT count(*) FROM preds WHERE model_type = 'isolation_forest') AS target_rows,
  (SELECT count(*) FROM traffic) = (SELECT count(*) FROM preds WHERE model_type = 'isolation_forest')
    AS counts_match""",
)
def reconcile_counts(spark, folder):
    scored = tables.predictions(spark, folder).filter("model_type = 'isolation_forest'")
    return quality.reconcile_counts(tables.traffic(spark, folder), scored)
