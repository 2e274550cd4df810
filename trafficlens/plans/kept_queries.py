"""Results that are kept up to date load by load, compared with one pass over everything."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trafficlens.operators import encoding, rollups
from trafficlens.plans import kept_reports, tables
from trafficlens.plans.registry import SESSION_PREDS, SESSIONS, query, rounded, with_ctes
from trafficlens.plans.report_queries import ENDPOINT_SQL
from trafficlens.session import work_dir


def _place(spark, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


@query(
    "encode_growing",
    """WITH codes1 AS (SELECT l_partkey, (row_number() OVER (ORDER BY l_partkey::VARCHAR) - 1)::BIGINT AS code
  FROM lineitem WHERE l_shipdate < '1995-02-01' GROUP BY l_partkey),
codes2 AS (SELECT l_partkey, (row_number() OVER (ORDER BY l_partkey::VARCHAR) - 1 + (SELECT count(*) FROM codes1))::BIGINT AS code
  FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM codes1) GROUP BY l_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(a.code, (SELECT count(*) FROM codes1)) AS first_code, coalesce(a.code, b.code) AS second_code
FROM lineitem LEFT JOIN codes1 a USING (l_partkey) LEFT JOIN codes2 b USING (l_partkey)""",
)
def encode_growing(spark, folder):
    """Two loads; the second gives codes to new values only. The first version counts them as unseen."""
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    early, path = F.col("l_shipdate") < F.lit("1995-02-01").cast("timestamp_ntz"), _place(spark, "codes")
    encoding.extend_codes(lines.filter(early), path, 1, "l_partkey")
    encoding.extend_codes(lines.filter(~early), path, 2, "l_partkey")
    rows = lines.drop("l_shipdate")
    for version, name in ((1, "first_code"), (2, "second_code")):
        rows = encoding.apply_encoder(rows, encoding.read_codes(spark, path, version), "l_partkey", name)
    return rows


@query(
    "distinct_sketches",
    """SELECT date_trunc('year', l_shipdate)::TIMESTAMP AS "year", count(*) AS row_count, count(DISTINCT l_suppkey) AS sources, count(DISTINCT l_partkey) AS dests,
  true AS within_two_percent FROM lineitem GROUP BY 1""",
)
def distinct_sketches(spark, folder):
    """Sketches of hours, stored once and merged to years, beside the exact counts."""
    lines = tables.table(spark, folder, "lineitem").select("l_shipdate", "l_suppkey", "l_partkey")
    path = _place(spark, "sketches")
    rollups.hourly_sketches(lines, "l_shipdate", "l_suppkey", "l_partkey").write.parquet(path)
    kept = rollups.sketch_counts(rollups.merge_sketches(spark.read.parquet(path), "year"))
    exact = lines.groupBy(F.date_trunc("year", "l_shipdate").cast("timestamp_ntz").alias("year")).agg(
        F.count_distinct("l_suppkey").alias("sources"), F.count_distinct("l_partkey").alias("dests"))

    def close(estimate, count):
        return F.abs(F.col(estimate) - F.col(count)) <= 0.02 * F.col(count)

    both = kept.join(exact, "year").withColumn("within_two_percent", close("unique_sources", "sources") & close("unique_dests", "dests"))
    return both.select("year", "row_count", "sources", "dests", "within_two_percent")


def _kept(spark, folder) -> str:
    """Sessions in two loads, an old scoring between them that is wrong for many, and the newest scoring last."""
    sessions, root = tables.sessions(spark, folder), _place(spark, "kept")
    newest = tables.session_predictions(spark, folder)
    older = sessions.select(
        F.col("id").alias("session_id"), F.lit("isolation_forest").alias("model_type"),
        F.when(F.col("total_price") < 100000, 1).otherwise(0).alias("prediction"),
        (F.col("TSesStart") - F.expr("interval 1 day")).alias("log_time"))
    early = F.col("TSesStart") < F.lit("1997-01-01").cast("timestamp_ntz")
    kept_reports.add_sessions(sessions.filter(early), root, "sessions-1")
    kept_reports.add_scores(older, root, "scores-1")
    kept_reports.add_sessions(sessions.filter(~early), root, "sessions-2")
    kept_reports.add_scores(newest, root, "scores-2")
    # Neither a load that comes twice nor an old score that comes late changes anything.
    kept_reports.add_sessions(sessions.filter(early), root, "sessions-1")
    kept_reports.add_scores(older, root, "scores-3")
    return root


@query("kept_endpoint_stats", ENDPOINT_SQL)
def kept_endpoint_stats(spark, folder):
    """The endpoint report after two loads of sessions and three of scores."""
    return rounded(kept_reports.session_stats(spark, _kept(spark, folder)), 6, total_packets=4, total_bytes=4, anomaly_rate=2)


@query(
    "kept_traffic_summary",
    with_ctes(SESSIONS, SESSION_PREDS)
    + """SELECT started::DATE AS date, hour(started)::INT AS hour, count(*) AS session_count,
  round(sum(pkt_in + pkt_out), 4) AS total_packets, round(sum(b_in + b_out), 4) AS total_bytes,
  round(avg(pkt_in + pkt_out), 6) AS avg_packets_per_session, round(avg(b_in + b_out), 6) AS avg_bytes_per_session,
  count(CASE WHEN prediction = 1 THEN 1 END) AS anomaly_count,
  round(count(CASE WHEN prediction = 1 THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS anomaly_percentage
FROM sessions LEFT JOIN newest ON session_id = id GROUP BY 1, 2""",
)
def kept_traffic_summary(spark, folder):
    """The hourly report after the same loads."""
    return rounded(kept_reports.traffic_summary(spark, _kept(spark, folder)), 6, total_packets=4, total_bytes=4, anomaly_percentage=2)
