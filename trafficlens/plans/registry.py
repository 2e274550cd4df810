"""Named queries and the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the equivalent SQL over the given tables where there is one."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 9, **special: int) -> DataFrame:
    """Round double columns, as sums of doubles depend on the order of addition."""
    doubles = {
        f.name: F.round(f"`{f.name}`", special.get(f.name, digits))
        for f in df.schema
        if f.dataType.typeName() == "double"
    }
    return df.withColumns(doubles) if doubles else df


# Shared pieces of the SQL.
TRAFFIC = """traffic AS (
  SELECT event_id AS id, ts AS log_time, user_id AS source_id, event_type AS traffic_type,
         value AS packet_size, (props->>'k')::INT AS k FROM events)"""

PREDS = """preds AS (
  SELECT id AS session_id, log_time, 'isolation_forest' AS model_type,
         CASE WHEN packet_size > 80 THEN 1 ELSE 0 END AS prediction,
         ((100.0::DOUBLE - packet_size) / 100.0::DOUBLE) AS anomaly_score FROM traffic
  UNION ALL
  SELECT id, log_time, 'random_forest', CASE WHEN traffic_type = 'error' THEN 1 ELSE 0 END,
         CASE WHEN traffic_type = 'error' THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END FROM traffic)"""

RESULTS = """results AS (
  SELECT id AS original_id, log_time, ((100.0::DOUBLE - packet_size) / 100.0::DOUBLE) AS anomaly_score,
         CASE WHEN packet_size > 80 THEN 1 ELSE 0 END AS is_anomaly FROM traffic)"""

LABELLED = """labelled AS (
  SELECT id, log_time, packet_size, CASE WHEN traffic_type = 'error' THEN 1 ELSE 0 END AS label,
         CASE WHEN packet_size > 100 THEN 1 ELSE 0 END AS predicted_label FROM traffic)"""

SESSIONS = """per_order AS (
  SELECT l_orderkey,
         coalesce(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 0) AS pkt_in,
         coalesce(sum(CASE WHEN l_linestatus <> 'O' THEN l_quantity END), 0) AS pkt_out,
         coalesce(sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END), 0) AS b_in,
         coalesce(sum(CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END), 0) AS b_out,
         max(l_shipdate) AS ended
  FROM lineitem GROUP BY l_orderkey),
sessions AS (
  SELECT o_orderkey AS id, 'c' || o_custkey::VARCHAR AS src, o_orderstatus AS dst, 0 AS sport,
         substr(o_orderpriority, 1, 1)::INT AS dport, o_orderdate AS started, ended,
         (epoch_us(ended) - epoch_us(o_orderdate))::DOUBLE / 1000000 AS duration,
         coalesce(pkt_in, 0) AS pkt_in, coalesce(pkt_out, 0) AS pkt_out,
         coalesce(b_in, 0) AS b_in, coalesce(b_out, 0) AS b_out
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey)"""

SESSION_PREDS = """newest AS (
  SELECT o_orderkey AS session_id,
         CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS prediction FROM orders)"""

HISTORY = """daily AS (
  SELECT log_time::DATE AS day, label, predicted_label AS p, count(*) AS n
  FROM labelled GROUP BY ALL),
sides AS (
  SELECT day, label AS c, n AS support, CASE WHEN label = p THEN n ELSE 0 END AS hits, 0 AS predicted FROM daily
  UNION ALL SELECT day, p, 0, 0, n FROM daily),
per_class AS (
  SELECT day, c, sum(support)::DOUBLE AS s, sum(hits)::DOUBLE AS h, sum(predicted)::DOUBLE AS q
  FROM sides GROUP BY day, c),
history AS (
  SELECT day::TIMESTAMP AS "timestamp", sum(h) / sum(s) AS accuracy,
         sum(coalesce(h / nullif(q, 0), 0) * s) / sum(s) AS "precision",
         sum(coalesce(h / nullif(s, 0), 0) * s) / sum(s) AS recall,
         sum(coalesce(2 * h / nullif(q + s, 0), 0) * s) / sum(s) AS f1_score,
         sum(s)::BIGINT AS sample_size
  FROM per_class GROUP BY day)"""

RUNS = """runs AS (
  SELECT strftime(log_time::DATE, '%Y%m%d') AS run_id, (log_time::DATE)::TIMESTAMP AS "timestamp",
         CASE WHEN isodow(log_time::DATE) < 6 THEN 'supervised' ELSE 'unsupervised' END AS mode,
         (epoch_us(max(log_time)) - epoch_us(min(log_time)))::DOUBLE / 1000000 AS execution_time_seconds,
         max(packet_size) <= 300 AS success, count(*) AS data_rows
  FROM traffic GROUP BY log_time::DATE)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
