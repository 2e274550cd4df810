"""The three reporting views, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.columns import number_of, risk_band
from trafficlens.operators.quality import newest_predictions

DETECTOR = "isolation_forest"  # fixed value
NEVER = -(1 << 62)  # a prediction without a time is older than any other

TRAFFIC_SUMMARY = """
WITH detector AS (
  SELECT session_id, max_by(prediction, coalesce(2 * unix_micros(CAST(log_time AS TIMESTAMP)), {never}) + prediction) AS prediction
  FROM {predictions} WHERE model_type = '{model}' GROUP BY session_id
), hourly AS (
  SELECT to_date(s.TSesStart) AS date,
         hour(s.TSesStart) AS hour,
         count(*) AS session_count,
         sum(s.PktPerSesIn + s.PktPerSesOut) AS total_packets,
         sum(s.BPerSesIn + s.BPerSesOut) AS total_bytes,
         avg(s.PktPerSesIn + s.PktPerSesOut) AS avg_packets_per_session,
         avg(s.BPerSesIn + s.BPerSesOut) AS avg_bytes_per_session,
         count_if(d.prediction = 1) AS anomaly_count
  FROM {sessions} s LEFT JOIN detector d ON d.session_id = s.id
  GROUP BY to_date(s.TSesStart), hour(s.TSesStart)
)
SELECT *, round(anomaly_count * 100 / session_count, 2) AS anomaly_percentage
FROM hourly ORDER BY date DESC, hour DESC
"""

ANOMALY_ANALYSIS = """
SELECT s.*, a.prediction, a.anomaly_score, a.traffic_type, a.is_anomaly,
       a.risk AS risk_level,
       a.model_type, a.log_time AS prediction_time
FROM {sessions} s JOIN {newest} a ON a.session_id = s.id AND a.prediction = 1
ORDER BY a.anomaly_score, s.TSesStart DESC
"""

SESSION_STATS = """
WITH detector AS (
  SELECT session_id, max_by(prediction, coalesce(2 * unix_micros(CAST(log_time AS TIMESTAMP)), {never}) + prediction) AS prediction
  FROM {predictions} WHERE model_type = '{model}' GROUP BY session_id
), endpoints AS (
  SELECT s.srcIP AS source_ip, s.dstIP AS dest_ip, s.srcPort AS source_port, s.dstPort AS dest_port,
         count(*) AS session_count,
         sum(s.PktPerSesIn + s.PktPerSesOut) AS total_packets,
         sum(s.BPerSesIn + s.BPerSesOut) AS total_bytes,
         avg(s.PktPerSesIn + s.PktPerSesOut) AS avg_packets,
         avg(s.BPerSesIn + s.BPerSesOut) AS avg_bytes,
         avg(s.SessDuration) AS avg_duration_seconds,
         count_if(d.prediction = 1) AS anomaly_sessions,
         max(s.TSesStart) AS last_session_time
  FROM {sessions} s LEFT JOIN detector d ON d.session_id = s.id
  GROUP BY s.srcIP, s.dstIP, s.srcPort, s.dstPort
)
SELECT *, round(anomaly_sessions * 100 / session_count, 2) AS anomaly_rate
FROM endpoints WHERE session_count > 1 ORDER BY session_count DESC
"""


#: Session columns that the reports sum and average.
AMOUNTS = ("PktPerSesIn", "PktPerSesOut", "BPerSesIn", "BPerSesOut", "SessDuration")


def register_views(
    sessions: DataFrame, predictions: DataFrame, prefix: str = "", model: str = DETECTOR
) -> dict[str, DataFrame]:
    """Create or replace the session and prediction views and the three reports over them.

    Only the newest prediction per session and model takes part, so a session scored
    twice counts once. The two rollups need one flag per session, which a hash
    aggregate on the join key yields without a further shuffle.
    """
    spark = sessions.sparkSession
    # NaN and infinities count as missing in the sums and means of the reports.
    amounts = {c: number_of(sessions, c) for c in AMOUNTS if c in sessions.columns}
    views = {
        "sessions": sessions.withColumns(amounts) if amounts else sessions,
        "predictions": predictions,
        "newest": newest_predictions(predictions).withColumn("risk", risk_band(F.col("anomaly_score"))),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
    names = {name: f"{prefix}{name}" for name in views} | {"model": model, "never": NEVER}
    texts = {
        "traffic_summary": TRAFFIC_SUMMARY,
        "anomaly_analysis": ANOMALY_ANALYSIS,
        "session_stats": SESSION_STATS,
    }
    reports = {}
    for name, text in texts.items():
        reports[name] = spark.sql(text.format(**names))
        reports[name].createOrReplaceTempView(f"{prefix}{name}")
    return reports
