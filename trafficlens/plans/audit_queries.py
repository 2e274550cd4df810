"""Dirty inputs, sinks and jobs over the given tables, written, read back and compared with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.operators import correlation, features, iforest, quality, rollups, rules
from trafficlens.plans import jobs, tables
from trafficlens.plans.registry import HISTORY, LABELLED, PREDS, RUNS, SESSIONS, TRAFFIC, query, rounded, with_ctes
from trafficlens.session import work_dir
from trafficlens.sources import batches, readers, schemas, writers

# The same rows as tables.dirty_traffic, with NULL for what counts as missing.
DIRTY = """dirty AS (
  SELECT id, CASE WHEN traffic_type <> 'view' THEN log_time END AS log_time, source_id, traffic_type,
         CASE WHEN traffic_type NOT IN ('error', 'signup') THEN packet_size END AS packet_size, k FROM traffic)"""
_D = with_ctes(TRAFFIC, DIRTY)


def place(spark, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


@query(
    "zscore_dirty",
    _D
    + """SELECT id, coalesce(abs(packet_size - (SELECT avg(packet_size) FROM dirty)) / (SELECT stddev_samp(packet_size) FROM dirty) > 3, false)
  AS packet_size_anomaly FROM dirty""",
)
def zscore_dirty(spark, folder):
    return rules.zscore_flags(tables.dirty_traffic(spark, folder), ["packet_size"]).select("id", "packet_size_anomaly")


@query(
    "histogram_dirty",
    _D
    + """, span AS (SELECT min(packet_size) AS lo, (max(packet_size) - min(packet_size)) / 50.0::DOUBLE AS w FROM dirty),
c AS (SELECT least(floor((packet_size - lo) / w), 49)::INT AS bin, count(*) AS n FROM dirty, span WHERE packet_size IS NOT NULL GROUP BY 1)
SELECT b.bin::INT AS bin, round(lo + b.bin * w, 9) AS bin_low, round(lo + (b.bin + 1) * w, 9) AS bin_high, coalesce(n, 0) AS row_count
FROM (SELECT unnest(range(50)) AS bin) b, span LEFT JOIN c ON c.bin = b.bin""",
)
def histogram_dirty(spark, folder):
    return rounded(rollups.histogram(tables.dirty_traffic(spark, folder), "packet_size"))


@query(
    "standardize_dirty",
    _D
    + """SELECT id, round((packet_size - (SELECT avg(packet_size) FROM dirty)) / (SELECT stddev_pop(packet_size) FROM dirty), 8) AS packet_size
FROM dirty""",
)
def standardize_dirty(spark, folder):
    return rounded(features.standardize(tables.dirty_traffic(spark, folder), ["packet_size"]).select("id", "packet_size"), 8)


@query(
    "correlation_dirty",
    _D
    + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM dirty"
        for a in ("packet_size", "k", "source_id") for b in ("packet_size", "k", "source_id")),
)
def correlation_dirty(spark, folder):
    return rounded(correlation.correlation_long(tables.dirty_traffic(spark, folder), ["packet_size", "k", "source_id"]), 6)


@query(
    "rule_labels_dirty",
    _D
    + """, gaps AS (SELECT *, CASE WHEN log_time IS NULL THEN 0 ELSE coalesce((epoch_us(log_time) - epoch_us(lag(log_time) OVER (
    PARTITION BY source_id, log_time IS NULL ORDER BY log_time, id)))::DOUBLE / 1000000, 0) END AS diff_seconds FROM dirty)
SELECT id, round(diff_seconds, 6) AS diff_seconds,
  CASE WHEN packet_size > 300 OR packet_size < 0.5 OR traffic_type = 'signup' OR (diff_seconds > 0 AND diff_seconds < 60) THEN 1 ELSE 0 END AS anomaly_flag
FROM gaps""",
)
def rule_labels_dirty(spark, folder):
    """An infinite size is large; a NaN one is unknown; a row without a time has no gap."""
    made = rules.rule_labels(tables.dirty_traffic(spark, folder), "source_id", "log_time", large=300, small=0.5, rapid=60)
    return rounded(made.select("id", "diff_seconds", "anomaly_flag"), 6)


@query(
    "hourly_dirty",
    _D
    + """SELECT date_trunc('hour', log_time) AS hour, round(avg(packet_size), 9) AS packet_size_mean, round(sum(packet_size), 6) AS packet_size_sum,
  count(packet_size) AS packet_size_count, count(id) AS session_count FROM dirty GROUP BY 1""",
)
def hourly_dirty(spark, folder):
    return rounded(rollups.hourly_metrics(tables.dirty_traffic(spark, folder), "log_time", ["packet_size"]), 9, packet_size_sum=6)


@query(
    "infer_schema_audit",
    """SELECT * FROM (VALUES ('event_id', 'bigint'), ('ts', 'string'), ('user_id', 'bigint'), ('event_type', 'string'), ('value', 'double'),
  ('large', 'boolean'), ('rare', 'bigint'), ('code', 'string'), ('unit', 'string')) AS t(column_name, column_type)""",
)
def infer_schema_audit(spark, folder):
    """Types of the events written as CSV; one column has values in error rows only, two hold codes."""
    path = place(spark, "typed-csv")
    events = tables.table(spark, folder, "events")
    rows = events.select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value", (F.col("value") > 100).alias("large"),
        F.when(F.col("event_type") == "error", F.col("user_id")).alias("rare"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("code"), F.concat(F.col("user_id").cast("string"), F.lit("D")).alias("unit"))
    writers.export_csv(rows, path, sep=";")
    found = schemas.infer_csv_schema(spark, path)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found], "column_name string, column_type string")


@query(
    "csv_rejects",
    _D.replace(DIRTY, "bad AS (SELECT count(*) AS n FROM traffic WHERE traffic_type = 'error')")
    + """SELECT (SELECT count(*) FROM traffic) - n AS good_rows, n AS bad_rows, n AS kept_texts,
  (SELECT round(sum(packet_size), 4) FROM traffic WHERE traffic_type <> 'error') AS good_sum FROM bad""",
)
def csv_rejects(spark, folder):
    """Errors get an unreadable size; they are set aside with their text and counted."""
    path = place(spark, "rejects")
    size = F.when(F.col("traffic_type") == "error", F.lit("n/a")).otherwise(F.col("packet_size").cast("string"))
    writers.export_csv(tables.traffic(spark, folder).select("id", "source_id", size.alias("packet_size")), f"{path}/csv")
    schema = T.StructType.fromDDL("id long, source_id long, packet_size double")
    frames, rejected = readers.load_layouts(spark, {"traffic": (f"{path}/csv", schema, ["id", "packet_size"])}, f"{path}/aside")
    kept = spark.read.parquet(f"{path}/aside/traffic").agg(F.count("*")).first()[0]
    return frames["traffic"].agg(F.count("*").alias("good_rows"), F.round(F.sum("packet_size"), 4).alias("good_sum")).select(
        "good_rows", F.lit(rejected["traffic"]).cast("long").alias("bad_rows"), F.lit(kept).cast("long").alias("kept_texts"), "good_sum")


@query("plain_csv_scan", with_ctes(TRAFFIC) + "SELECT id, log_time, traffic_type, packet_size FROM traffic")
def plain_csv_scan(spark, folder):
    """The traffic as comma CSV, read back with a fixed schema."""
    path = place(spark, "plain-csv")
    rows = tables.traffic(spark, folder).select("id", "log_time", "traffic_type", "packet_size")
    writers.export_csv(rows, path)
    return readers.split_bad_records(readers.read_csv(spark, path, rows.schema))[0]


@query(
    "predictions_both_models",
    with_ctes(TRAFFIC, PREDS)
    + """SELECT model_type, CASE WHEN prediction = 1 THEN 'anomaly' ELSE 'normal' END AS traffic_type, log_time::DATE AS day, count(*) AS row_count,
  round(sum(anomaly_score), 6) AS score_sum FROM preds GROUP BY ALL""",
)
def predictions_both_models(spark, folder):
    """Both models' rows in one table; the first model's are replaced without touching the other's."""
    out, rows = place(spark, "predictions"), tables.predictions(spark, folder)
    for model in (jobs.DETECTOR, jobs.CLASSIFIER, jobs.DETECTOR):
        stored = jobs.store_predictions(rows.filter(F.col("model_type") == model).drop("model_type"), out, model)
    groups = stored.groupBy("model_type", "traffic_type", F.to_date("log_time").alias("day"))
    return rounded(groups.agg(F.count("*").alias("row_count"), F.sum("anomaly_score").alias("score_sum")), 6)


_ENTRIES = 16


@query(
    "correlation_wide",
    " UNION ALL ".join(
        f"SELECT 'e{a}' AS column_a, 'e{b}' AS column_b, round(corr(embedding[{a + 1}]::DOUBLE, embedding[{b + 1}]::DOUBLE), 6) AS correlation FROM embeddings"
        for a in range(_ENTRIES) for b in range(_ENTRIES)),
)
def correlation_wide(spark, folder):
    """Correlations of more columns than the pairwise form takes."""
    e = tables.table(spark, folder, "embeddings")
    wide = e.select(*[F.col("embedding")[i].alias(f"e{i}") for i in range(_ENTRIES)])
    return rounded(correlation.correlation_long(wide, wide.columns), 6)


@query(
    "run_log_json",
    with_ctes(TRAFFIC, RUNS)
    + """SELECT run_id, mode, success, 2 AS step_count, mode AS last_step, data_rows::DOUBLE AS rows_metric, data_rows::VARCHAR AS rows_text FROM runs""",
)
def run_log_json(spark, folder):
    """Run records with their step lists and maps, through JSON lines."""
    path = place(spark, "runs")
    log = tables.run_log(spark, folder)
    records = readers.conform(log, {f.name: F.lit(None) for f in schemas.layout("pipeline_runs")} | {
        "run_id": "run_id", "timestamp": "timestamp", "mode": "mode", "execution_time_seconds": "execution_time_seconds", "success": "success",
        "steps_completed": F.array(F.lit("ingest"), F.col("mode")), "metrics": F.create_map(F.lit("rows"), F.col("data_rows").cast("double")),
        "data_stats": F.create_map(F.lit("rows"), F.col("data_rows").cast("string")),
    }, schemas.layout("pipeline_runs"))
    writers.append_json(records, path)
    return writers.read_runs(spark, path).select(
        "run_id", "mode", "success", F.size("steps_completed").alias("step_count"), F.element_at("steps_completed", -1).alias("last_step"),
        F.col("metrics")["rows"].alias("rows_metric"), F.col("data_stats")["rows"].alias("rows_text"))


@query(
    "metric_history_json",
    with_ctes(TRAFFIC, LABELLED, HISTORY)
    + """SELECT "timestamp", round(accuracy, 9) AS accuracy, round(f1_score, 9) AS f1_score, sample_size FROM history ORDER BY "timestamp" DESC LIMIT 100""",
)
def metric_history_json(spark, folder):
    """Performance records through the JSON history, the newest hundred."""
    path = place(spark, "metrics")
    records = tables.performance_history(spark, folder)
    writers.append_metrics(records.withColumn("timestamp", F.col("timestamp").cast("timestamp")), path)
    kept = writers.read_metrics(spark, path).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return rounded(kept.select("timestamp", "accuracy", "f1_score", "sample_size"))


@query(
    "batch_run_audit",
    with_ctes(SESSIONS)
    + """SELECT count(*) AS total_records, count(*) AS classified, true AS flags_add_up, true AS tenth_flagged, 2 AS models, 2 * count(*) AS prediction_rows
FROM sessions""",
)
def batch_run_audit(spark, folder):
    """The whole batch run over the sessions, with a label that follows from the price."""
    sessions = tables.sessions(spark, folder).withColumn("label", (F.col("total_price") > 250000).cast("int"))
    done = jobs.run_batch(spark, sessions.drop("total_price"), place(spark, "batch"), validate=True)
    stored = done.frames["predictions"].agg(F.count("*").alias("n"), F.count_distinct("model_type").alias("m")).first()
    total = F.col("total_records")
    return done.frames["summary_stats"].select(
        total.alias("total_records"), F.col("supervised_predictions").alias("classified"),
        (F.col("anomaly_count") + F.col("normal_count") == total).alias("flags_add_up"),
        F.col("anomaly_count").between(0.09 * total, 0.1 * total + 1).alias("tenth_flagged"),
        F.lit(stored["m"]).cast("int").alias("models"), F.lit(stored["n"]).cast("long").alias("prediction_rows"))


@query(
    "iforest_audit",
    with_ctes(TRAFFIC)
    + "SELECT count(*) AS row_count, count(DISTINCT id) AS ids, true AS tenth_flagged, true AS signs_agree FROM traffic",
)
def iforest_audit(spark, folder):
    """Every row once, a tenth below the threshold, and flags that follow the score's sign."""
    scored, _ = iforest.detect(tables.traffic(spark, folder).select("id", "packet_size", "k"), "id", ["packet_size", "k"])
    flagged = F.count_if(F.col("prediction") == 1)
    return scored.agg(
        F.count("*").alias("row_count"), F.count_distinct("id").alias("ids"),
        (flagged.between(0.09 * F.count("*"), 0.1 * F.count("*") + 1)).alias("tenth_flagged"),
        F.bool_and((F.col("anomaly_score") < 0) == (F.col("prediction") == 1)).alias("signs_agree"))


@query(
    "chart_counts",
    with_ctes(TRAFFIC)
    + """SELECT 'traffic_over_time' AS chart, count(*) AS row_count FROM traffic UNION ALL SELECT 'anomaly_distribution', 2
UNION ALL SELECT 'traffic_types', count(DISTINCT traffic_type) FROM traffic UNION ALL SELECT 'packet_sizes', 50
UNION ALL SELECT 'scores_over_time', count(*) FROM traffic UNION ALL SELECT 'correlation', 9""",
)
def chart_counts(spark, folder):
    """Rows of the data behind each chart."""
    t = tables.traffic(spark, folder)
    score = (F.lit(100.0) - F.col("packet_size")) / 100.0
    rows = t.select(F.col("log_time").alias("timestamp"), "traffic_type", "packet_size", score.alias("anomaly_score"), (score < 0.2).cast("int").alias("is_anomaly"))
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("chart"), "row_count") for name, df in jobs.chart_data(rows).items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "hourly_sync_audit",
    with_ctes(TRAFFIC)
    + """SELECT count(*) AS traffic_rows,
  date_diff('hour', date_trunc('hour', min(log_time)), date_trunc('hour', max(log_time))) + 1 AS prediction_rows,
  count(DISTINCT date_trunc('hour', log_time)) AS aligned_hours, count(*) FILTER (packet_size > 200) AS traffic_anomalies FROM traffic""",
)
def hourly_sync_audit(spark, folder):
    """Every hour predicted from its mean size, both tables replaced and aligned."""
    t = tables.traffic(spark, folder)
    packets = t.select("id", F.col("log_time").alias("timestamp"), "packet_size")
    model = iforest.fit_forest(packets.withColumn("hour", F.hour("timestamp")), "id", ["packet_size", "hour"])
    return jobs.hourly_sync(packets, model, place(spark, "sync"), threshold=200).drop("prediction_anomalies")


@query(
    "alignment_dirty",
    with_ctes(TRAFFIC, PREDS, DIRTY)
    + """SELECT (SELECT count(*) FROM dirty) AS traffic_rows, (SELECT count(*) FROM preds) AS prediction_rows,
  (SELECT count(*) FROM (SELECT date_trunc('hour', log_time) FROM dirty WHERE log_time IS NOT NULL INTERSECT
                         SELECT date_trunc('hour', log_time) FROM preds)) AS aligned_hours,
  (SELECT count(*) FROM dirty WHERE packet_size > 200 OR traffic_type = 'signup') AS traffic_anomalies,
  (SELECT count(*) FROM preds WHERE prediction = 1) AS prediction_anomalies""",
)
def alignment_dirty(spark, folder):
    """An infinite size is an anomaly, a NaN one is not."""
    return quality.alignment_audit(
        tables.dirty_traffic(spark, folder), tables.predictions(spark, folder), "log_time", "log_time", "packet_size", threshold=200)


@query(
    "summary_dirty",
    with_ctes(TRAFFIC, DIRTY, LABELLED)
    + """SELECT count(*) AS total_records, count(CASE WHEN k > 50 THEN 1 END) AS anomaly_count, count(CASE WHEN k <= 50 THEN 1 END) AS normal_count,
  round(avg(packet_size), 9) AS avg_anomaly_score, min(packet_size) AS min_anomaly_score, max(packet_size) AS max_anomaly_score,
  (SELECT count(*) FROM labelled) AS supervised_predictions, round(count(CASE WHEN k > 50 THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS anomaly_percentage,
  (SELECT round(count(CASE WHEN label = predicted_label THEN 1 END) * 100.0::DOUBLE / count(*), 2) FROM labelled) AS model_accuracy,
  count(*) - count(packet_size) AS missing_scores FROM dirty""",
)
def summary_dirty(spark, folder):
    """Score range and mean where scores are NaN or infinite."""
    rows = tables.dirty_traffic(spark, folder).select(
        F.col("id").alias("original_id"), F.col("packet_size").alias("anomaly_score"), F.when(F.col("k") > 50, 1).when(F.col("k") <= 50, 0).alias("is_anomaly"))
    missing = rollups.score_audit(rows).select("missing_scores").scalar()
    return rounded(rollups.summary_extended(rows, tables.labelled(spark, folder)).withColumn("missing_scores", missing))


@query(
    "batch_append",
    with_ctes(TRAFFIC, DIRTY)
    + """SELECT traffic_type, traffic_type NOT IN ('error') AND log_time IS NOT NULL AS complete, count(*) AS row_count, sum(id)::BIGINT AS id_sum
FROM dirty GROUP BY ALL""",
)
def batch_append(spark, folder):
    """Three batches, one of which fails at first and one of which comes twice; good and bad rows by type."""
    root, rows = place(spark, "batches"), tables.dirty_traffic(spark, folder)

    def batch(k):
        return rows.filter(F.pmod("id", F.lit(3)) == k)

    batches.append_batch(batch(0), root, "first", ["packet_size", "log_time"])
    # An attempt that ends after writing and before its marker leaves nothing to see.
    batch(1).withColumn(batches.COMPLETE, F.lit(True)).write.partitionBy(batches.COMPLETE).parquet(f"{root}/batches/batch=second/attempt=failed")
    for k, name in ((1, "second"), (0, "first"), (2, "third")):
        batches.append_batch(batch(k), root, name, ["packet_size", "log_time"])
    kept = batches.read_batches(spark, root).withColumn("complete", F.lit(True)).unionByName(batches.read_batches(spark, root, False).withColumn("complete", F.lit(False)))
    return kept.groupBy("traffic_type", "complete").agg(F.count("*").alias("row_count"), F.sum("id").alias("id_sum"))


@query(
    "incremental_ties",
    with_ctes(TRAFFIC)
    + """, hours AS (SELECT id, date_trunc('hour', log_time) AS hour, (SELECT date_trunc('day', min(log_time)) + (max(log_time) - min(log_time)) / 2 FROM traffic) AS middle FROM traffic),
marked AS (SELECT *, hour < date_trunc('hour', middle) OR (hour = date_trunc('hour', middle) AND id % 3 <> 0) AS early FROM hours)
SELECT id, hour, CASE WHEN early THEN 1 ELSE 2 END AS load FROM marked""",
)
def incremental_ties(spark, folder):
    """Two loads that split the rows of one instant; no row is lost or loaded twice."""
    t = tables.traffic(spark, folder)
    rows = t.select("id", F.date_trunc("hour", "log_time").cast("timestamp_ntz").alias("hour"))
    ends = t.agg(F.min("log_time").alias("a"), F.max("log_time").alias("b")).first()
    middle = ends["a"].replace(hour=0, minute=0, second=0, microsecond=0) + (ends["b"] - ends["a"]) / 2
    middle = F.date_trunc("hour", F.lit(middle)).cast("timestamp_ntz")
    arrived = rows.filter((F.col("hour") < middle) | ((F.col("hour") == middle) & (F.col("id") % 3 != 0)))
    nothing = spark.createDataFrame([], "hour timestamp_ntz, id long")
    path = place(spark, "marks")
    first = readers.rows_since(arrived, nothing, "hour", "id")
    writers.replace_table(readers.composite_mark(first, "hour", "id"), path)
    second = readers.rows_since(rows, spark.read.parquet(path), "hour", "id")
    return first.withColumn("load", F.lit(1)).unionByName(second.withColumn("load", F.lit(2)))
