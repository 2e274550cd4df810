"""Streaming forms run over the whole events table until everything available is processed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trafficlens.operators import iforest
from trafficlens.plans import tables
from trafficlens.plans.audit_queries import DIRTY
from trafficlens.plans.forest_sql import forest_ctes
from trafficlens.plans.registry import TRAFFIC, query, rounded, with_ctes
from trafficlens.session import work_dir
from trafficlens.streaming import gaps, incremental


def _event_stream(spark, folder):
    schema = tables.table(spark, folder, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return files.select(F.col("event_id").alias("id"), F.col("ts").alias("log_time"), F.col("value").alias("packet_size"))


def _place(spark, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


@query(
    "hourly_stream",
    with_ctes(TRAFFIC)
    + """SELECT date_trunc('hour', log_time) AS hour, count(packet_size) AS packet_count,
  round(avg(packet_size), 9) AS avg_packet_size, round(sum(packet_size), 6) AS total_packet_size,
  min(packet_size) AS min_packet_size, max(packet_size) AS max_packet_size
FROM traffic GROUP BY 1
HAVING date_trunc('hour', log_time) + INTERVAL 1 HOUR <= (SELECT max(log_time) FROM traffic) - INTERVAL 2 HOUR""",
)
def hourly_stream(spark, folder):
    """Closed hours of the streaming rollup, with a watermark of two hours."""
    place = _place(spark, "hourly-stream")
    hours = incremental.hourly_stream(_event_stream(spark, folder), "log_time", "packet_size", "2 hours")
    incremental.run_hourly(hours, f"{place}/out", f"{place}/checkpoint").awaitTermination()
    done = spark.read.parquet(f"{place}/out")
    return rounded(done.withColumn("hour", F.col("hour").cast("timestamp_ntz")), total_packet_size=6)


@query(
    "stream_scores",
    with_ctes(TRAFFIC, forest_ctes("traffic", "id", ["packet_size"], "auto"))
    + """SELECT id AS session_id, prediction, round(anomaly_score, 9) AS anomaly_score,
  CASE WHEN anomaly_score < -0.5 THEN 'High Risk' WHEN anomaly_score < 0 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level
FROM forest_scores JOIN forest_rows USING (rid)""",
)
def stream_scores(spark, folder):
    """Rows scored as they arrive, with a forest frozen before the stream starts."""
    t = tables.traffic(spark, folder).select("id", "packet_size")
    model = iforest.fit_forest(t, "id", ["packet_size"])
    place = _place(spark, "stream-scores")
    stream = _event_stream(spark, folder)
    incremental.score_new_rows(stream, model, f"{place}/out", f"{place}/checkpoint").awaitTermination()
    done = incremental.read_scored(spark, f"{place}/out")
    return rounded(done.select("session_id", "prediction", "anomaly_score", "risk_level"))


@query(
    "hourly_stream_dirty",
    with_ctes(TRAFFIC, DIRTY)
    + """SELECT date_trunc('hour', log_time) AS hour, count(packet_size) AS packet_count,
  round(avg(packet_size), 9) AS avg_packet_size, round(sum(packet_size), 6) AS total_packet_size,
  min(packet_size) AS min_packet_size, max(packet_size) AS max_packet_size
FROM dirty WHERE log_time IS NOT NULL GROUP BY 1
HAVING date_trunc('hour', log_time) + INTERVAL 1 HOUR <= (SELECT max(log_time) FROM dirty) - INTERVAL 2 HOUR""",
)
def hourly_stream_dirty(spark, folder):
    """Closed hours where sizes are NaN or infinite and times are missing."""
    place = _place(spark, "hourly-dirty")
    tables.dirty_traffic(spark, folder).select("log_time", "packet_size").write.parquet(f"{place}/in")
    stream = incremental.read_new_files(spark, f"{place}/in", spark.read.parquet(f"{place}/in").schema)
    hours = incremental.hourly_stream(stream, "log_time", "packet_size", "2 hours")
    incremental.run_hourly(hours, f"{place}/out", f"{place}/checkpoint").awaitTermination()
    done = spark.read.parquet(f"{place}/out")
    return rounded(done.withColumn("hour", F.col("hour").cast("timestamp_ntz")), total_packet_size=6)


def _in_files(spark, rows, place: str, parts: int, part):
    """The rows as a stream that brings one of ``parts`` files at a time."""
    rows.withColumn("part", part).repartition(parts, "part").write.partitionBy("part").parquet(f"{place}/in")
    schema = rows.schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{place}/in")


@query(
    "hourly_late",
    with_ctes(TRAFFIC)
    + """SELECT date_trunc('hour', log_time) AS hour, count(packet_size) AS packet_count, round(sum(packet_size), 6) AS total_packet_size,
  min(packet_size) AS min_packet_size, max(packet_size) AS max_packet_size, round(avg(packet_size), 9) AS avg_packet_size FROM traffic GROUP BY 1""",
)
def hourly_late(spark, folder):
    """All hours, though every file brings rows of every hour; merged once in between."""
    place = _place(spark, "hourly-late")
    rows = tables.traffic(spark, folder).select("log_time", "packet_size")
    stream = _in_files(spark, rows, place, 5, F.pmod(F.xxhash64("log_time"), F.lit(5)))
    incremental.merge_hours(stream, f"{place}/out", f"{place}/checkpoint", "log_time", "packet_size").awaitTermination()
    incremental.compact_hours(spark, f"{place}/out")
    return rounded(incremental.read_hours(spark, f"{place}/out"), total_packet_size=6)


@query(
    "rule_label_stream",
    with_ctes(TRAFFIC)
    + """, gaps AS (SELECT id, log_time, source_id, packet_size, coalesce((epoch_us(log_time) - epoch_us(lag(log_time) OVER (
    PARTITION BY source_id ORDER BY log_time, id)))::DOUBLE / 1000000, 0) AS diff_seconds FROM traffic),
hits AS (SELECT *, packet_size > 300 OR packet_size < 0.5 OR (diff_seconds > 0 AND diff_seconds < 60) AS hit FROM gaps)
SELECT id, log_time, source_id, round(diff_seconds, 6) AS diff_seconds, CASE WHEN hit THEN 1 ELSE 0 END AS anomaly_flag,
  CASE WHEN hit THEN -1 ELSE 1 END AS anomaly_score, CASE WHEN hit THEN 'anomaly' ELSE 'normal' END AS traffic_type
FROM hits WHERE epoch_us(log_time) < epoch_ms((SELECT max(log_time) FROM traffic) - INTERVAL 2 HOUR) * 1000""",
)
def rule_label_stream(spark, folder):
    """Labels of all rows older than the watermark; the rows of the files come in no order."""
    place = _place(spark, "rule-stream")
    rows = tables.traffic(spark, folder).select("id", "log_time", "source_id", "packet_size")
    rows.repartition(4).write.parquet(f"{place}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{place}/in")
    found = gaps.rule_label_stream(stream, "source_id", "log_time", large=300, small=0.5, rapid=60)
    done = found.drop("packet_size").writeStream.format("parquet").option("path", f"{place}/out").option(
        "checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start()
    done.awaitTermination()
    out = spark.read.parquet(f"{place}/out").withColumn("log_time", F.col("log_time").cast("timestamp_ntz"))
    return rounded(out, 6)
