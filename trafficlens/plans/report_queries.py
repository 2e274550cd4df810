"""Rollup, rule, join, evaluation and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficlens.operators import classifiers, correlation, evaluation, features, monitoring, quality, rollups, rules
from trafficlens.plans import tables
from trafficlens.plans.registry import (
    HISTORY,
    LABELLED,
    PREDS,
    RESULTS,
    RUNS,
    SESSION_PREDS,
    SESSIONS,
    TRAFFIC,
    query,
    rounded,
    with_ctes,
)
from trafficlens.plans.views import register_views

_T = with_ctes(TRAFFIC)


def _traffic_views(spark, folder):
    """Reports with the traffic rows as the session side."""
    t = tables.traffic(spark, folder)
    zero = F.lit(0)
    as_sessions = t.select(
        "id",
        F.col("source_id").cast("string").alias("srcIP"),
        F.col("traffic_type").alias("dstIP"),
        F.lit(0).alias("srcPort"),
        F.lit(0).alias("dstPort"),
        F.col("log_time").alias("TSesStart"),
        F.lit(0.0).alias("SessDuration"),
        F.col("k").alias("PktPerSesIn"),
        zero.alias("PktPerSesOut"),
        F.col("packet_size").alias("BPerSesIn"),
        F.lit(0.0).alias("BPerSesOut"),
    )
    preds = tables.predictions(spark, folder).withColumn("traffic_type", F.lit("network"))
    return register_views(as_sessions, preds, prefix="traffic_")


@query(
    "traffic_summary",
    with_ctes(TRAFFIC, PREDS)
    + """SELECT t.log_time::DATE AS date, hour(t.log_time)::INT AS hour, count(*) AS session_count,
  sum(t.k)::BIGINT AS total_packets, round(sum(t.packet_size), 4) AS total_bytes,
  round(avg(t.k), 9) AS avg_packets_per_session, round(avg(t.packet_size), 9) AS avg_bytes_per_session,
  count(CASE WHEN p.prediction = 1 THEN 1 END) AS anomaly_count,
  round(count(CASE WHEN p.prediction = 1 THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS anomaly_percentage
FROM traffic t LEFT JOIN preds p ON t.id = p.session_id AND p.model_type = 'isolation_forest'
GROUP BY ALL ORDER BY date DESC, hour DESC""",
)
def traffic_summary(spark, folder):
    return rounded(_traffic_views(spark, folder)["traffic_summary"], total_bytes=4, anomaly_percentage=2)


@query(
    "anomaly_analysis",
    with_ctes(TRAFFIC, PREDS)
    + """SELECT t.id, t.source_id::VARCHAR AS source, t.log_time AS started, t.packet_size AS bytes_in, p.prediction,
  round(p.anomaly_score, 9) AS anomaly_score,
  CASE WHEN p.anomaly_score < -0.5 THEN 'High Risk' WHEN p.anomaly_score < 0 THEN 'Medium Risk'
       ELSE 'Low Risk' END AS risk_level,
  p.model_type, p.log_time AS prediction_time
FROM traffic t JOIN preds p ON t.id = p.session_id WHERE p.prediction = 1
ORDER BY p.anomaly_score, t.log_time DESC""",
)
def anomaly_analysis(spark, folder):
    report = _traffic_views(spark, folder)["anomaly_analysis"]
    return rounded(
        report.select(
            "id",
            F.col("srcIP").alias("source"),
            F.col("TSesStart").alias("started"),
            F.col("BPerSesIn").alias("bytes_in"),
            "prediction",
            "anomaly_score",
            "risk_level",
            "model_type",
            "prediction_time",
        )
    )


ENDPOINT_SQL = (
    with_ctes(SESSIONS, SESSION_PREDS)
    + """SELECT src AS source_ip, dst AS dest_ip, sport AS source_port, dport AS dest_port, count(*) AS session_count,
  round(sum(pkt_in + pkt_out), 4) AS total_packets, round(sum(b_in + b_out), 4) AS total_bytes,
  round(avg(pkt_in + pkt_out), 6) AS avg_packets, round(avg(b_in + b_out), 6) AS avg_bytes,
  round(avg(duration), 6) AS avg_duration_seconds, count(CASE WHEN prediction = 1 THEN 1 END) AS anomaly_sessions,
  max(started) AS last_session_time,
  round(count(CASE WHEN prediction = 1 THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS anomaly_rate
FROM sessions LEFT JOIN newest ON session_id = id
GROUP BY src, dst, sport, dport HAVING count(*) > 1"""
)


def _endpoint_stats(spark, folder):
    views = register_views(
        tables.sessions(spark, folder), tables.session_predictions(spark, folder), prefix="endpoint_"
    )
    return rounded(views["session_stats"], 6, total_packets=4, total_bytes=4, anomaly_rate=2)


@query("endpoint_stats", ENDPOINT_SQL + " ORDER BY session_count DESC")
def endpoint_stats(spark, folder):
    return _endpoint_stats(spark, folder)


@query(
    "top_endpoints",
    f"SELECT * FROM ({ENDPOINT_SQL}) ORDER BY session_count DESC, total_bytes DESC, source_ip, dest_ip, dest_port LIMIT 20",
)
def top_endpoints(spark, folder):
    order = [F.desc("session_count"), F.desc("total_bytes"), "source_ip", "dest_ip", "dest_port"]
    return _endpoint_stats(spark, folder).orderBy(*order).limit(20)


@query(
    "newest_predictions",
    """SELECT o_orderkey AS session_id, CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS prediction,
  round(CASE WHEN (300000.0::DOUBLE - o_totalprice) / 300000.0::DOUBLE < -0.25::DOUBLE
    THEN (300000.0::DOUBLE - o_totalprice) / 300000.0::DOUBLE - 0.5::DOUBLE
    ELSE (300000.0::DOUBLE - o_totalprice) / 300000.0::DOUBLE END, 9) AS anomaly_score,
  CASE WHEN (300000.0::DOUBLE - o_totalprice) / 300000.0::DOUBLE < -0.25::DOUBLE
    THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS log_time
FROM orders""",
)
def newest_predictions(spark, folder):
    """Sessions scored twice keep their later row."""
    newest = quality.newest_predictions(tables.session_predictions(spark, folder))
    return rounded(newest.select("session_id", "prediction", "anomaly_score", "log_time"))


_ZSCORE = """z AS (SELECT *, coalesce(abs(packet_size - avg(packet_size) OVER ())
  / nullif(stddev_samp(packet_size) OVER (), 0) > 3, false) AS hit FROM traffic)"""


@query(
    "zscore_flags",
    with_ctes(TRAFFIC, _ZSCORE)
    + """SELECT id, packet_size, hit AS packet_size_anomaly, hit AS statistical_anomaly,
  CASE WHEN hit THEN 1 ELSE 0 END AS prediction, CASE WHEN hit THEN 'anomaly' ELSE 'normal' END AS traffic_type
FROM z""",
)
def zscore_flags(spark, folder):
    return rules.zscore_flags(tables.traffic(spark, folder).select("id", "packet_size"), ["packet_size"])


_GAPS = """gaps AS (SELECT id, log_time, source_id, packet_size,
  coalesce((epoch_us(log_time) - epoch_us(lag(log_time) OVER (PARTITION BY source_id ORDER BY log_time, id)))::DOUBLE
    / 1000000, 0) AS diff_seconds FROM traffic)"""


@query("interarrival", with_ctes(TRAFFIC, _GAPS) + "SELECT id, source_id, round(diff_seconds, 6) AS diff_seconds FROM gaps")
def interarrival(spark, folder):
    t = tables.traffic(spark, folder).select("id", "log_time", "source_id")
    return rounded(rules.interarrival(t, "source_id", "log_time", "id").drop("log_time"), 6)


@query(
    "rule_labels",
    with_ctes(TRAFFIC, _GAPS)
    + """, hits AS (SELECT *, packet_size > 300 OR packet_size < 0.5 OR (diff_seconds > 0 AND diff_seconds < 60) AS hit
  FROM gaps)
SELECT id, log_time, source_id, round(diff_seconds, 6) AS diff_seconds, CASE WHEN hit THEN 1 ELSE 0 END AS anomaly_flag,
  CASE WHEN hit THEN -1 ELSE 1 END AS anomaly_score, CASE WHEN hit THEN 'anomaly' ELSE 'normal' END AS traffic_type
FROM hits""",
)
def rule_labels(spark, folder):
    t = tables.traffic(spark, folder).select("id", "log_time", "source_id", "packet_size")
    made = rules.rule_labels(t, "source_id", "log_time", large=300, small=0.5, rapid=60)
    return rounded(made.drop("packet_size"), 6)


@query(
    "labels_by_time",
    with_ctes(TRAFFIC, PREDS)
    + """, instants AS (SELECT log_time, max(prediction) AS prediction FROM preds GROUP BY log_time)
SELECT t.id, t.source_id, t.packet_size, i.log_time, i.prediction FROM traffic t JOIN instants i USING (log_time)""",
)
def labels_by_time(spark, folder):
    t = tables.traffic(spark, folder).select("id", "source_id", "packet_size", "log_time")
    labels = tables.predictions(spark, folder).select("log_time", "prediction")
    return quality.labels_by_time(t, labels, "log_time")


@query(
    "alignment_audit",
    with_ctes(TRAFFIC, PREDS)
    + """SELECT (SELECT count(*) FROM traffic) AS traffic_rows, (SELECT count(*) FROM preds) AS prediction_rows,
  (SELECT count(*) FROM (SELECT date_trunc('hour', log_time) FROM traffic INTERSECT
                         SELECT date_trunc('hour', log_time) FROM preds)) AS aligned_hours,
  (SELECT count(*) FROM traffic WHERE packet_size > 200) AS traffic_anomalies,
  (SELECT count(*) FROM preds WHERE prediction = 1) AS prediction_anomalies""",
)
def alignment_audit(spark, folder):
    return quality.alignment_audit(
        tables.traffic(spark, folder), tables.predictions(spark, folder), "log_time", "log_time", "packet_size", threshold=200
    )


@query(
    "orphan_predictions",
    with_ctes(SESSION_PREDS)
    + """SELECT session_id, 'isolation_forest' AS model_type, prediction FROM newest
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = session_id)
UNION ALL
SELECT o_orderkey, 'isolation_forest', 1 FROM orders
WHERE (300000.0::DOUBLE - o_totalprice) / 300000.0::DOUBLE < -0.25::DOUBLE
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def orphan_predictions(spark, folder):
    """Scores of orders, first and second ones, without any order line."""
    lines = tables.table(spark, folder, "lineitem")
    lost = quality.orphans(tables.session_predictions(spark, folder), lines, "session_id", "l_orderkey")
    return lost.select("session_id", "model_type", "prediction")


@query(
    "summary_stats",
    with_ctes(TRAFFIC, RESULTS)
    + """SELECT count(*) AS total_records, sum(is_anomaly)::BIGINT AS anomaly_count,
  (count(*) - sum(is_anomaly))::BIGINT AS normal_count,
  round(coalesce(sum(is_anomaly) * 100.0::DOUBLE / nullif(count(*), 0), 0), 9) AS anomaly_percentage FROM results""",
)
def summary_stats(spark, folder):
    return rounded(rollups.summary_stats(tables.results(spark, folder)))


@query(
    "summary_extended",
    with_ctes(TRAFFIC, RESULTS, LABELLED)
    + """SELECT count(*) AS total_records, sum(is_anomaly)::BIGINT AS anomaly_count,
  (count(*) - sum(is_anomaly))::BIGINT AS normal_count, round(avg(anomaly_score), 9) AS avg_anomaly_score,
  round(min(anomaly_score), 9) AS min_anomaly_score, round(max(anomaly_score), 9) AS max_anomaly_score,
  (SELECT count(*) FROM labelled) AS supervised_predictions,
  round(sum(is_anomaly) * 100.0::DOUBLE / count(*), 2) AS anomaly_percentage,
  (SELECT round(count(CASE WHEN label = predicted_label THEN 1 END) * 100.0::DOUBLE / count(*), 2) FROM labelled)
    AS model_accuracy
FROM results""",
)
def summary_extended(spark, folder):
    return rounded(rollups.summary_extended(tables.results(spark, folder), tables.labelled(spark, folder)))


@query(
    "score_audit",
    with_ctes(TRAFFIC, RESULTS)
    + """SELECT count(*) AS row_count, round(min(anomaly_score), 9) AS min_score, round(max(anomaly_score), 9) AS max_score,
  count(*) - count(anomaly_score) AS missing_scores FROM results""",
)
def score_audit(spark, folder):
    return rounded(rollups.score_audit(tables.results(spark, folder)))


SPINE = """spine AS (SELECT unnest(generate_series(date_trunc('hour', min(log_time)), date_trunc('hour', max(log_time)),
  INTERVAL 1 HOUR)) AS hour FROM traffic)"""


HOURS = """per_hour AS (SELECT date_trunc('hour', log_time) AS hour, count(packet_size) AS n, avg(packet_size) AS a,
  stddev_samp(packet_size) AS s, min(packet_size) AS lo, max(packet_size) AS hi,
  count(DISTINCT source_id) AS src, count(DISTINCT traffic_type) AS dst FROM traffic GROUP BY 1),
hours AS (SELECT hour, coalesce(n, 0) AS packet_count, coalesce(a, 0) AS avg_packet_size, coalesce(s, 0) AS std_packet_size,
  coalesce(lo, 0) AS min_packet_size, coalesce(hi, 0) AS max_packet_size, coalesce(src, 0) AS unique_source_ips,
  coalesce(dst, 0) AS unique_dest_ips FROM spine LEFT JOIN per_hour USING (hour))"""


@query(
    "hourly_features",
    with_ctes(TRAFFIC, SPINE, HOURS)
    + """SELECT hour, packet_count, round(avg_packet_size, 9) AS avg_packet_size, round(std_packet_size, 9) AS std_packet_size,
  min_packet_size, max_packet_size, unique_source_ips, unique_dest_ips FROM hours""",
)
def hourly_features(spark, folder):
    t = tables.traffic(spark, folder)
    return rounded(rollups.hourly_features(t, "log_time", "packet_size", "source_id", "traffic_type"))


@query(
    "hourly_metrics",
    _T
    + """SELECT date_trunc('hour', log_time) AS hour, round(avg(packet_size), 9) AS packet_size_mean,
  round(sum(packet_size), 9) AS packet_size_sum, count(packet_size) AS packet_size_count, round(avg(k), 9) AS k_mean,
  sum(k)::BIGINT AS k_sum, count(k) AS k_count, count(id) AS session_count FROM traffic GROUP BY 1""",
)
def hourly_metrics(spark, folder):
    return rounded(rollups.hourly_metrics(tables.traffic(spark, folder), "log_time", ["packet_size", "k"]))


_ORDER_SPINE = """spine AS (SELECT unnest(generate_series(date_trunc('hour', min(o_orderdate)), date_trunc('hour', max(o_orderdate)),
  INTERVAL 1 HOUR)) AS hour FROM orders)"""


@query(
    "hourly_resample",
    with_ctes(_ORDER_SPINE)
    + """SELECT hour, round(m, 6) AS mean_o_totalprice FROM spine LEFT JOIN
  (SELECT date_trunc('hour', o_orderdate) AS hour, avg(o_totalprice) AS m FROM orders GROUP BY 1) USING (hour)""",
)
def hourly_resample(spark, folder):
    """Hourly mean of the order prices; hours without an order are NULL."""
    return rounded(rollups.hourly_resample(tables.table(spark, folder, "orders"), "o_orderdate", "o_totalprice"), 6)


@query(
    "hourly_gaps",
    with_ctes(_ORDER_SPINE) + "SELECT hour FROM spine WHERE hour NOT IN (SELECT date_trunc('hour', o_orderdate) FROM orders)",
)
def hourly_gaps(spark, folder):
    """Hours in the span of the orders without one."""
    orders = tables.table(spark, folder, "orders")
    return rollups.hourly_gaps(orders, orders, "o_orderdate", "o_orderdate")


@query(
    "hourly_backfill",
    with_ctes(_ORDER_SPINE)
    + """SELECT hour, 2000 + (hour(hour)::INT * 17) % 2000 AS packet_size,
  '192.168.' || (hour(hour) % 256)::VARCHAR || '.1' AS source_ip,
  '192.168.' || ((hour(hour) + 1) % 256)::VARCHAR || '.2' AS dest_ip
FROM spine WHERE hour NOT IN (SELECT date_trunc('hour', o_orderdate) FROM orders)""",
)
def hourly_backfill(spark, folder):
    """One deterministic row for every hour without an order."""
    orders = tables.table(spark, folder, "orders")
    return features.hour_attributes(rollups.hourly_gaps(orders, orders, "o_orderdate", "o_orderdate"), "hour")


@query(
    "type_distribution",
    _T
    + """SELECT traffic_type, count(*) AS row_count,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM traffic), 4) AS share_percent FROM traffic GROUP BY 1""",
)
def type_distribution(spark, folder):
    return rollups.distribution(tables.traffic(spark, folder), "traffic_type")


@query(
    "size_histogram",
    _T
    + """, span AS (SELECT min(packet_size) AS lo, (max(packet_size) - min(packet_size)) / 50.0::DOUBLE AS w,
  avg(packet_size) AS mean_value, quantile_cont(packet_size, 0.5) AS median_value FROM traffic),
c AS (SELECT least(floor((packet_size - lo) / w), 49)::INT AS bin, count(*) AS n FROM traffic, span GROUP BY 1)
SELECT b.bin::INT AS bin, round(lo + b.bin * w, 9) AS bin_low, round(lo + (b.bin + 1) * w, 9) AS bin_high,
  coalesce(n, 0) AS row_count, round(mean_value, 9) AS mean_value, round(median_value, 9) AS median_value
FROM (SELECT unnest(range(50)) AS bin) b, span LEFT JOIN c ON c.bin = b.bin""",
)
def size_histogram(spark, folder):
    return rounded(rollups.size_histogram(tables.traffic(spark, folder), "packet_size"))


def _correlation_sql() -> str:
    names = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    pairs = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
        for a in names
        for b in names
    ]
    return " UNION ALL ".join(pairs)


@query("correlation_long", _correlation_sql())
def correlation_long(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    return rounded(correlation.correlation_long(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]), 6)


@query(
    "confusion_matrix",
    with_ctes(TRAFFIC, LABELLED)
    + "SELECT label, predicted_label AS prediction, count(*) AS row_count FROM labelled GROUP BY ALL",
)
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(tables.labelled(spark, folder), "label", "predicted_label")


_REPORT = """c AS (SELECT label::VARCHAR AS c FROM labelled UNION SELECT predicted_label::VARCHAR FROM labelled),
s AS (SELECT c AS class_name,
  (SELECT count(*) FROM labelled WHERE label::VARCHAR = c)::DOUBLE AS n,
  (SELECT count(*) FROM labelled WHERE label::VARCHAR = c AND predicted_label::VARCHAR = c)::DOUBLE AS h,
  (SELECT count(*) FROM labelled WHERE predicted_label::VARCHAR = c)::DOUBLE AS q FROM c),
m AS (SELECT class_name, n, h, coalesce(h / nullif(q, 0), 0) AS p, coalesce(h / nullif(n, 0), 0) AS r,
  coalesce(2 * h / nullif(q + n, 0), 0) AS f FROM s)"""


@query(
    "classification_report",
    with_ctes(TRAFFIC, LABELLED, _REPORT)
    + """SELECT class_name, round(p, 9) AS "precision", round(r, 9) AS recall, round(f, 9) AS f1_score,
  n::BIGINT AS support FROM m
UNION ALL SELECT 'accuracy', round(sum(h) / sum(n), 9), round(sum(h) / sum(n), 9), round(sum(h) / sum(n), 9),
  sum(n)::BIGINT FROM m
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), sum(n)::BIGINT FROM m
UNION ALL SELECT 'weighted avg', round(sum(p * n) / sum(n), 9), round(sum(r * n) / sum(n), 9),
  round(sum(f * n) / sum(n), 9), sum(n)::BIGINT FROM m""",
)
def classification_report(spark, folder):
    return rounded(evaluation.classification_report(tables.labelled(spark, folder), "label", "predicted_label"))


@query(
    "binary_scores",
    with_ctes(TRAFFIC, LABELLED)
    + """, c AS (SELECT count(*)::DOUBLE AS n, count(CASE WHEN label = predicted_label THEN 1 END) AS ok,
  count(CASE WHEN label = 1 AND predicted_label = 1 THEN 1 END)::DOUBLE AS h,
  sum(predicted_label)::DOUBLE AS q, sum(label)::DOUBLE AS s FROM labelled)
SELECT round(ok / n, 9) AS accuracy, round(h / q, 9) AS "precision", round(h / s, 9) AS recall,
  round(2 * h / (q + s), 9) AS f1_score FROM c""",
)
def binary_scores(spark, folder):
    return rounded(evaluation.binary_scores(tables.labelled(spark, folder), "label", "predicted_label"))


@query(
    "roc_auc",
    with_ctes(TRAFFIC, LABELLED)
    + """, r AS (SELECT label, rank() OVER (ORDER BY packet_size)
  + (count(*) OVER (PARTITION BY packet_size) - 1) / 2.0::DOUBLE AS mid FROM labelled),
t AS (SELECT sum(label)::BIGINT AS p, (count(*) - sum(label))::BIGINT AS n,
  sum(CASE WHEN label = 1 THEN mid END) AS m FROM r)
SELECT p AS positives, n AS negatives, round((m - p * (p + 1) / 2.0::DOUBLE) / (p::DOUBLE * n), 9) AS auc FROM t""",
)
def roc_auc(spark, folder):
    return rounded(evaluation.roc_auc(tables.labelled(spark, folder), "label", "packet_size"))


@query(
    "class_weights",
    _T
    + """SELECT traffic_type, count(*) AS row_count,
  round((SELECT count(*) FROM traffic) / ((SELECT count(DISTINCT traffic_type) FROM traffic) * count(*)::DOUBLE), 9)
    AS weight FROM traffic GROUP BY 1""",
)
def class_weights(spark, folder):
    return rounded(classifiers.class_weights(tables.traffic(spark, folder), "traffic_type"))


_H = with_ctes(TRAFFIC, LABELLED, HISTORY)


@query(
    "performance_history",
    _H
    + """SELECT "timestamp", round(accuracy, 9) AS accuracy, round("precision", 9) AS "precision",
  round(recall, 9) AS recall, round(f1_score, 9) AS f1_score, sample_size FROM history""",
)
def performance_history(spark, folder):
    return rounded(tables.performance_history(spark, folder))


_RECENT = """, recent AS (SELECT *, row_number() OVER (ORDER BY "timestamp") - 1 AS x FROM
  (SELECT * FROM history ORDER BY "timestamp" DESC LIMIT 10))"""


@query(
    "metric_trend",
    _H
    + _RECENT
    + """SELECT round(max_by(accuracy, x), 9) AS current_accuracy, round(avg(accuracy), 9) AS avg_accuracy,
  round(stddev_pop(accuracy), 9) AS accuracy_std, round(regr_slope(accuracy, x), 9) AS accuracy_trend,
  round(max_by(f1_score, x), 9) AS current_f1, round(avg(f1_score), 9) AS avg_f1,
  round(stddev_pop(f1_score), 9) AS f1_std, round(regr_slope(f1_score, x), 9) AS f1_trend
FROM recent HAVING count(*) = 10""",
)
def metric_trend(spark, folder):
    return rounded(monitoring.metric_trend(tables.performance_history(spark, folder)))


@query(
    "retrain_decision",
    _H
    + _RECENT
    + """SELECT count(*) AS records, round(max_by(accuracy, x), 9) AS current_accuracy,
  round(avg(accuracy), 9) AS avg_accuracy, round(max_by(f1_score, x), 9) AS current_f1, round(avg(f1_score), 9) AS avg_f1,
  count(*) = 10 AND (max_by(accuracy, x) < avg(accuracy) - 0.05 OR max_by(f1_score, x) < avg(f1_score) - 0.05)
    AS retrain FROM recent""",
)
def retrain_decision(spark, folder):
    return rounded(monitoring.retrain_decision(tables.performance_history(spark, folder)))


@query(
    "monitoring_summary",
    _H
    + _RECENT
    + """SELECT (SELECT count(*) FROM history) AS total_runs, "timestamp", round(accuracy, 9) AS accuracy,
  round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1_score, 9) AS f1_score, sample_size,
  (SELECT count(*) = 10 AND (max_by(accuracy, x) < avg(accuracy) - 0.05
    OR max_by(f1_score, x) < avg(f1_score) - 0.05) FROM recent) AS retraining_needed,
  (SELECT round(regr_slope(accuracy, x), 9) FROM recent HAVING count(*) = 10) AS accuracy_trend,
  (SELECT round(regr_slope(f1_score, x), 9) FROM recent HAVING count(*) = 10) AS f1_trend
FROM history ORDER BY "timestamp" DESC LIMIT 1""",
)
def monitoring_summary(spark, folder):
    return rounded(monitoring.monitoring_summary(tables.performance_history(spark, folder)))


_R = with_ctes(TRAFFIC, RUNS)


@query("recent_runs", _R + """SELECT run_id, mode, success, data_rows FROM runs ORDER BY "timestamp" DESC LIMIT 10""")
def recent_runs(spark, folder):
    return monitoring.recent_runs(tables.run_log(spark, folder)).select("run_id", "mode", "success", "data_rows")


@query(
    "run_log_summary",
    _R
    + """SELECT count(*) AS total_runs, count(CASE WHEN success THEN 1 END) AS successful_runs,
  count(CASE WHEN NOT success THEN 1 END) AS failed_runs,
  round(avg(execution_time_seconds), 9) AS average_execution_time,
  count(CASE WHEN mode = 'supervised' THEN 1 END) AS supervised_runs,
  count(CASE WHEN mode = 'unsupervised' THEN 1 END) AS unsupervised_runs, max(run_id) AS last_run,
  round(count(CASE WHEN success THEN 1 END) / count(*)::DOUBLE, 9) AS success_rate FROM runs""",
)
def run_log_summary(spark, folder):
    return rounded(monitoring.run_log_summary(tables.run_log(spark, folder)))


@query(
    "run_report",
    with_ctes(TRAFFIC, RUNS, RESULTS, LABELLED)
    + """, c AS (SELECT count(*)::DOUBLE AS n, count(CASE WHEN label = predicted_label THEN 1 END) AS ok,
  count(CASE WHEN label = 1 AND predicted_label = 1 THEN 1 END)::DOUBLE AS h,
  sum(predicted_label)::DOUBLE AS q, sum(label)::DOUBLE AS s FROM labelled)
SELECT run_id, mode, round(execution_time_seconds, 9) AS execution_time_seconds, success,
  round(ok / n, 9) AS accuracy, round(h / q, 9) AS "precision", round(h / s, 9) AS recall,
  round(2 * h / (q + s), 9) AS f1_score, (SELECT count(*) FROM results) AS data_rows,
  (SELECT sum(is_anomaly)::BIGINT FROM results) AS anomaly_count,
  (SELECT round(sum(is_anomaly) * 100 / count(*)::DOUBLE, 2) FROM results) AS anomaly_percentage
FROM runs, c ORDER BY "timestamp" DESC LIMIT 1""",
)
def run_report(spark, folder):
    scores = evaluation.binary_scores(tables.labelled(spark, folder), "label", "predicted_label")
    report = monitoring.run_report(tables.run_log(spark, folder), tables.results(spark, folder), scores)
    return rounded(report, anomaly_percentage=2)


@query(
    "run_report_text",
    with_ctes(TRAFFIC, RUNS, RESULTS, LABELLED)
    + """, c AS (SELECT count(*)::DOUBLE AS n, count(CASE WHEN label = predicted_label THEN 1 END) AS ok,
  count(CASE WHEN label = 1 AND predicted_label = 1 THEN 1 END)::DOUBLE AS h,
  sum(predicted_label)::DOUBLE AS q, sum(label)::DOUBLE AS s FROM labelled),
last AS (SELECT * FROM runs ORDER BY "timestamp" DESC LIMIT 1)
SELECT 0 AS line, 'Run: ' || run_id AS value FROM last
UNION ALL SELECT 1, 'Mode: ' || mode FROM last
UNION ALL SELECT 2, printf('Execution time: %.2f seconds', execution_time_seconds) FROM last
UNION ALL SELECT 3, 'Success: ' || success::VARCHAR FROM last
UNION ALL SELECT 4, printf('Accuracy: %.4f', ok / n) FROM c
UNION ALL SELECT 5, printf('Precision: %.4f', h / q) FROM c
UNION ALL SELECT 6, printf('Recall: %.4f', h / s) FROM c
UNION ALL SELECT 7, printf('F1 score: %.4f', 2 * h / (q + s)) FROM c
UNION ALL SELECT 8, 'Rows: ' || count(*)::VARCHAR FROM results
UNION ALL SELECT 9, 'Anomalies: ' || sum(is_anomaly)::VARCHAR FROM results
UNION ALL SELECT 10, printf('Anomaly percentage: %.2f%%', sum(is_anomaly) * 100 / count(*)::DOUBLE) FROM results""",
)
def run_report_text(spark, folder):
    scores = evaluation.binary_scores(tables.labelled(spark, folder), "label", "predicted_label")
    report = monitoring.run_report(tables.run_log(spark, folder), tables.results(spark, folder), scores)
    return monitoring.report_text(report)


@query(
    "hybrid_hours",
    with_ctes(TRAFFIC)
    + """, u AS (SELECT date_trunc('hour', log_time) AS hour,
    CASE WHEN max(packet_size) > 200 THEN 1 ELSE 0 END AS prediction,
    ((200.0::DOUBLE - max(packet_size)) / 200.0::DOUBLE) AS anomaly_score FROM traffic GROUP BY 1),
s AS (SELECT date_trunc('hour', log_time) AS hour, avg(CASE WHEN packet_size > 30 THEN 1 ELSE 0 END) AS mp,
    avg((30.0::DOUBLE - packet_size) / 30.0::DOUBLE) AS ms FROM traffic GROUP BY 1)
SELECT hour, prediction, round(anomaly_score, 9) AS anomaly_score,
  CASE WHEN mp IS NULL THEN NULL WHEN mp > 0.5 THEN 1 ELSE 0 END AS supervised_prediction,
  round(ms, 9) AS supervised_score,
  CASE WHEN mp IS NULL THEN NULL WHEN mp > 0.5 THEN 'anomaly' ELSE 'normal' END AS supervised_label,
  CASE WHEN mp IS NULL THEN prediction WHEN mp > 0.5 THEN 1 ELSE 0 END AS final_prediction,
  CASE WHEN CASE WHEN mp IS NULL THEN prediction WHEN mp > 0.5 THEN 1 ELSE 0 END = 1
       THEN 'anomaly' ELSE 'normal' END AS final_label,
  round(coalesce(ms, anomaly_score), 9) AS final_score,
  CASE WHEN mp IS NULL THEN prediction::DOUBLE
       ELSE (prediction + CASE WHEN mp > 0.5 THEN 1 ELSE 0 END) / 2.0::DOUBLE END AS ensemble_confidence
FROM u LEFT JOIN s USING (hour)""",
)
def hybrid_hours(spark, folder):
    """Hourly size detector combined with hourly labels of all rows."""
    t = tables.traffic(spark, folder)
    largest = F.max("packet_size")
    own = t.groupBy(F.date_trunc("hour", "log_time").cast("timestamp_ntz").alias("hour")).agg(
        F.when(largest > 200, 1).otherwise(0).alias("prediction"),
        ((F.lit(200.0) - largest) / 200.0).alias("anomaly_score"),
    )
    labels = t.select(
        "log_time",
        F.when(F.col("packet_size") > 30, 1).otherwise(0).alias("prediction"),
        ((F.lit(30.0) - F.col("packet_size")) / 30.0).alias("anomaly_score"),
    )
    return rounded(rollups.hybrid_hours(own, rollups.hourly_predictions(labels, "log_time")))
