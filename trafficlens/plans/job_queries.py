"""Jobs, saved models and sinks over the given tables, whose stored results are read back and compared by value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx
from trafficlens.operators import iforest
from trafficlens.plans import jobs, tables
from trafficlens.plans.audit_queries import place
from trafficlens.plans.forest_sql import forest_ctes
from trafficlens.plans.registry import LABELLED, SESSIONS, TRAFFIC, query, rounded, with_ctes
from trafficlens.sources import readers, schemas, writers

_RISK = "CASE WHEN anomaly_score < -0.5 THEN 'High Risk' WHEN anomaly_score < 0 THEN 'Medium Risk' ELSE 'Low Risk' END"
_STORED = ("session_id", "model_type", "prediction", "is_anomaly", "traffic_type", "risk_level", "anomaly_score")


def _both_models(rows: str, label: str) -> str:
    """Stored predictions of the forest and of a classifier whose label follows from one feature."""
    return f"""SELECT id AS session_id, 'isolation_forest' AS model_type, prediction, prediction AS is_anomaly, traffic_type,
  {_RISK} AS risk_level, round(anomaly_score, 9) AS anomaly_score FROM forest_scores JOIN forest_rows USING (rid)
UNION ALL SELECT id, 'random_forest', {label}, {label}, CASE WHEN {label} = 1 THEN 'anomaly' ELSE 'normal' END, NULL, NULL FROM {rows}"""


# Sessions without lines have no duration; the detector takes the mean there.
_READY = """ready AS (SELECT * REPLACE (coalesce(duration, avg(duration) OVER ()) AS duration) FROM sessions)"""
_SESSION_FEATURES = ("sport", "dport", "duration", "pkt_in", "pkt_out", "b_in", "b_out")
_URGENT = 3  # ports below are the positive class of the sessions


def _batch(spark, folder, label: bool, **options) -> jobs.RunOutcome:
    rows = tables.sessions(spark, folder).drop("total_price")
    if label:
        rows = rows.withColumn("label", (F.col("dstPort") < _URGENT).cast("int"))
    return jobs.run_batch(spark, rows, place(spark, "run"), **options)


@query(
    "batch_run_predictions",
    with_ctes(SESSIONS, _READY, forest_ctes("ready", "id", _SESSION_FEATURES)) + _both_models("sessions", f"(dport < {_URGENT})::INT"),
)
def batch_run_predictions(spark, folder):
    """The table of all predictions after a whole batch run: detector and classifier, every session."""
    return rounded(_batch(spark, folder, True, trees=25).frames["predictions"].select(*_STORED))


@query(
    "batch_run_views",
    with_ctes(SESSIONS, _READY, forest_ctes("ready", "id", _SESSION_FEATURES))
    + """SELECT started::DATE AS date, hour(started)::INT AS hour, count(*) AS session_count, round(sum(pkt_in + pkt_out), 4) AS total_packets,
  round(sum(b_in + b_out), 2) AS total_bytes, sum(prediction)::BIGINT AS anomaly_count,
  round(sum(prediction) * 100.0::DOUBLE / count(*), 2) AS anomaly_percentage
FROM sessions JOIN forest_rows USING (id) JOIN forest_scores USING (rid) GROUP BY ALL""",
)
def batch_run_views(spark, folder):
    """The hourly report that a run with views registers, without labels."""
    _batch(spark, folder, False, with_views=True)
    report = spark.table("traffic_summary").select(
        "date", "hour", "session_count", "total_packets", "total_bytes", "anomaly_count", "anomaly_percentage")
    return rounded(report, total_packets=4, total_bytes=2, anomaly_percentage=2)


_CODED = """coded AS (
  SELECT id, packet_size, k, dense_rank() OVER (ORDER BY traffic_type) - 1 AS code, traffic_type,
         hour(log_time) AS hour, isodow(log_time) - 1 AS day_of_week, month(log_time) AS month, day(log_time) AS day
  FROM traffic WHERE COLUMNS(*) IS NOT NULL)"""
_CODED_FEATURES = ("code", "packet_size", "k", "hour", "day_of_week", "month", "day")
_IS_ERROR = "(traffic_type = 'error')::INT"


def _requests(spark, folder) -> DataFrame:
    return tables.traffic(spark, folder).drop("source_id")


def _labelled_requests(spark, folder) -> DataFrame:
    return _requests(spark, folder).withColumn("label", (F.col("traffic_type") == "error").cast("int"))


@query("mode_run_predictions", with_ctes(TRAFFIC, _CODED, forest_ctes("coded", "id", _CODED_FEATURES)) + _both_models("coded", _IS_ERROR))
def mode_run_predictions(spark, folder):
    """A supervised and an unsupervised run into one folder; each keeps the other's rows."""
    out, rows = place(spark, "modes"), _labelled_requests(spark, folder)
    jobs.run_mode(spark, rows, out, "supervised", encode=["traffic_type"], trees=25)
    jobs.run_mode(spark, rows, out, "unsupervised", encode=["traffic_type"])
    return rounded(jobs.read_predictions(spark, out).select(*_STORED))


@query(
    "score_only_run",
    with_ctes(TRAFFIC, _CODED)
    + f"""SELECT id AS session_id, 'random_forest' AS model_type, {_IS_ERROR} AS prediction,
  CASE WHEN {_IS_ERROR} = 1 THEN 'anomaly' ELSE 'normal' END AS traffic_type FROM coded""",
)
def score_only_run(spark, folder):
    """Rows without a label, scored by the model that an earlier run saved; the earlier rows are replaced.

    The model was fitted without clicks, so their code is new to it and all other codes must be its own.
    """
    out, rows = place(spark, "modes"), _labelled_requests(spark, folder)
    jobs.run_mode(spark, rows.filter("traffic_type <> 'click'"), out, "supervised", encode=["traffic_type"], trees=25)
    jobs.run_mode(spark, rows.drop("label"), out, "supervised", encode=["traffic_type"])
    return jobs.read_predictions(spark, out).select("session_id", "model_type", "prediction", "traffic_type")


@query(
    "run_records",
    with_ctes(TRAFFIC)
    + """, sizes AS (SELECT count(*) FILTER (packet_size > 300) AS large, count(*) AS n FROM traffic)
SELECT 'unsupervised' AS mode, large > 0 AS success, CASE WHEN large > 0 THEN 'ingest,preprocessing,anomaly_detection,prediction_saving' ELSE '' END AS steps,
  CASE WHEN large = 0 THEN 'no input rows' END AS error_message FROM sizes
UNION ALL SELECT 'forecast', false, '', 'unknown mode: forecast' FROM sizes
UNION ALL SELECT 'supervised', false, '', 'no input rows' FROM sizes""",
)
def run_records(spark, folder):
    """Records of a run over the large packets, of a run in an unknown mode and of one without rows."""
    rows, log = _requests(spark, folder), place(spark, "records")
    large = rows.filter("packet_size > 300")
    for mode, part in (("unsupervised", large), ("forecast", rows), ("supervised", rows.filter("packet_size IS NULL AND id IS NULL"))):
        try:
            jobs.run_mode(spark, part.drop("traffic_type"), place(spark, "recorded"), mode, run_log=log)
        except ValueError:
            pass  # the record holds it
    return writers.read_runs(spark, log).select("mode", "success", F.array_join("steps_completed", ",").alias("steps"), "error_message")


_TIMED = "timed AS (SELECT id, packet_size, k, hour(log_time) AS hour FROM traffic)"


@query(
    "saved_forest_scores",
    with_ctes(TRAFFIC, _TIMED, forest_ctes("timed", "id", ["packet_size", "k", "hour"]))
    + "SELECT id, round(anomaly_score, 9) AS anomaly_score, prediction FROM forest_scores JOIN forest_rows USING (rid)",
)
def saved_forest_scores(spark, folder):
    """Every row scored by a forest that was stored and read back."""
    rows = tables.traffic(spark, folder).select("id", "packet_size", "k", F.hour("log_time").alias("hour"))
    path = place(spark, "forest")
    iforest.detect(rows, "id", ["packet_size", "k", "hour"])[1].save(spark, path)
    scored = iforest.score_forest(rows, iforest.IsolationForest.load(spark, path))
    return rounded(scored.select("id", "anomaly_score", "prediction"))


@query("csv_appends", with_ctes(TRAFFIC) + "SELECT id, log_time, traffic_type, packet_size, k FROM traffic")
def csv_appends(spark, folder):
    """Three appends to one CSV folder, read back with a fixed schema."""
    rows, path = tables.traffic(spark, folder).select("id", "log_time", "traffic_type", "packet_size", "k"), place(spark, "csv")
    for part in range(3):
        writers.append_csv(rows.filter(F.pmod("id", F.lit(3)) == part), path)
    good, _ = readers.split_bad_records(readers.read_csv(spark, path, rows.schema))
    return good


_RAW_NAMES = (" Event ID", "Log-Time", "<Packet Size>")  # as a source may deliver them


@query(
    "column_names",
    with_ctes(TRAFFIC)
    + """SELECT rule, name, n, round(total, 4) AS total FROM (
  SELECT 'standard' AS rule, unnest(['event_id', 'log_time', '_packet_size_']) AS name, unnest([count(id), count(log_time), count(packet_size)]) AS n,
         unnest([sum(id)::DOUBLE, sum(epoch_us(log_time) // 1000000 % 86400)::DOUBLE, sum(packet_size)]) AS total FROM traffic
  UNION ALL
  SELECT 'table', unnest(['_Event_ID', 'Log_Time', '_Packet_Size_']), unnest([count(id), count(log_time), count(packet_size)]),
         unnest([sum(id)::DOUBLE, sum(epoch_us(log_time) // 1000000 % 86400)::DOUBLE, sum(packet_size)]) FROM traffic)""",
)
def column_names(spark, folder):
    """Names of a CSV export under both renaming rules, with the values found under the new names."""
    t, path = tables.traffic(spark, folder), place(spark, "names")
    seconds = F.unix_seconds(F.col("log_time").cast("timestamp")) % 86400
    writers.export_csv(t.select("id", seconds.alias("s"), "packet_size").toDF(*_RAW_NAMES), path)
    # White space around names is part of them here.
    raw = spark.read.options(header=True, inferSchema=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path).toDF(*_RAW_NAMES)

    def found(rule: str, frame: DataFrame) -> DataFrame:
        cells = [F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("name"), F.count(fx.named(c)).alias("n"), F.sum(fx.named(c)).cast("double").alias("total"))
                 for c in frame.columns]
        return frame.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

    both = found("standard", schemas.rename_all(raw, schemas.standard_name)).unionByName(found("table", schemas.rename_all(raw, schemas.table_safe_name)))
    return rounded(both, 4)


_CHART_ROWS = """rows_ AS (
  SELECT log_time, traffic_type, packet_size, (100.0::DOUBLE - packet_size) / 100.0::DOUBLE AS anomaly_score,
         ((100.0::DOUBLE - packet_size) / 100.0::DOUBLE < 0.2)::INT AS is_anomaly FROM traffic),
span AS (SELECT min(packet_size) AS lo, (max(packet_size) - min(packet_size)) / 50.0::DOUBLE AS w FROM rows_),
bins AS (SELECT least(floor((packet_size - lo) / w), 49)::INT AS bin, count(*) AS n FROM rows_, span GROUP BY 1)"""
_CHART_PAIRS = "\n".join(
    f"UNION ALL SELECT 'correlation', '{a}|{b}', round(corr({a}, {b}), 6) FROM rows_"
    for a in ("packet_size", "anomaly_score", "is_anomaly") for b in ("packet_size", "anomaly_score", "is_anomaly"))


@query(
    "chart_values",
    with_ctes(TRAFFIC, _CHART_ROWS)
    + f"""SELECT 'traffic_over_time' AS chart, epoch_us(log_time)::VARCHAR AS label, round(packet_size, 6) AS value FROM rows_
UNION ALL SELECT 'anomaly_distribution', is_anomaly::VARCHAR, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM rows_), 4) FROM rows_ GROUP BY is_anomaly
UNION ALL SELECT 'traffic_types', traffic_type, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM rows_), 4) FROM rows_ GROUP BY traffic_type
UNION ALL SELECT 'packet_sizes', b.bin::VARCHAR, coalesce(n, 0)::DOUBLE FROM (SELECT unnest(range(50)) AS bin) b LEFT JOIN bins USING (bin)
UNION ALL SELECT 'scores_over_time', epoch_us(log_time)::VARCHAR || CASE WHEN anomaly_score < 0 THEN '|red' ELSE '|blue' END, round(anomaly_score, 6) FROM rows_
{_CHART_PAIRS}""",
)
def chart_values(spark, folder):
    """All points of all charts as (chart, label, value)."""
    t = tables.traffic(spark, folder)
    score = (F.lit(100.0) - F.col("packet_size")) / 100.0
    charts = jobs.chart_data(t.select(
        F.col("log_time").alias("timestamp"), "traffic_type", "packet_size", score.alias("anomaly_score"), (score < 0.2).cast("int").alias("is_anomaly")))
    instant = F.unix_micros(F.col("timestamp").cast("timestamp")).cast("string")
    points = {
        "traffic_over_time": (instant, F.col("packet_size")),
        "anomaly_distribution": (F.col("is_anomaly").cast("string"), F.col("share_percent")),
        "traffic_types": (F.col("traffic_type"), F.col("share_percent")),
        "packet_sizes": (F.col("bin").cast("string"), F.col("row_count").cast("double")),
        "scores_over_time": (F.concat_ws("|", instant, "colour"), F.col("anomaly_score")),
        "correlation": (F.concat_ws("|", "column_a", "column_b"), F.col("correlation")),
    }
    parts = [charts[name].select(F.lit(name).alias("chart"), label.alias("label"), value.alias("value")) for name, (label, value) in points.items()]
    return rounded(reduce(DataFrame.unionByName, parts), 6)


@query(
    "prediction_confidence",
    with_ctes(TRAFFIC, LABELLED)
    + """, chances AS (SELECT id, least(packet_size, 400.0) / 400.0::DOUBLE AS chance FROM labelled)
SELECT id, (chance > 0.25)::INT AS prediction, round(CASE WHEN chance > 0.25 THEN chance ELSE 1 - chance END, 9) AS confidence_score FROM chances""",
)
def prediction_confidence(spark, folder):
    """Confidence of a 0/1 prediction from the probability of class 1."""
    chance = F.least(F.col("packet_size"), F.lit(400.0)) / 400.0
    flag = (chance > 0.25).cast("int")
    return rounded(tables.labelled(spark, folder).select("id", flag.alias("prediction"), fx.binary_confidence(flag, chance).alias("confidence_score")))
