"""The given tables, seen as traffic, sessions, predictions and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx
from trafficlens.operators.evaluation import weighted_scores

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def traffic(spark: SparkSession, folder: str) -> DataFrame:
    """One row per packet or request, from events. Unused columns are never read."""
    e = table(spark, folder, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("log_time"),
        F.col("user_id").alias("source_id"),
        F.col("event_type").alias("traffic_type"),
        F.col("value").alias("packet_size"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Two prediction rows per traffic row: a size detector and an error classifier."""
    t = traffic(spark, folder)
    size_score = (F.lit(100.0) - F.col("packet_size")) / 100.0
    size_flag = F.when(F.col("packet_size") > 80, 1).otherwise(0)
    error_flag = F.when(F.col("traffic_type") == "error", 1).otherwise(0)
    both = F.array(
        F.struct(
            F.lit("isolation_forest").alias("model_type"),
            size_flag.alias("prediction"),
            size_score.alias("anomaly_score"),
        ),
        F.struct(
            F.lit("random_forest").alias("model_type"),
            error_flag.alias("prediction"),
            (F.lit(0.5) - error_flag).cast("double").alias("anomaly_score"),
        ),
    )
    rows = t.select(F.col("id").alias("session_id"), "log_time", F.inline(both))
    return rows.withColumn("is_anomaly", F.col("prediction"))


def dirty_traffic(spark: SparkSession, folder: str) -> DataFrame:
    """The traffic with NaN sizes of errors, infinite ones of signups, and views without a time."""
    size = (
        F.when(F.col("traffic_type") == "error", F.lit(float("nan")))
        .when(F.col("traffic_type") == "signup", F.lit(float("inf")))
        .otherwise(F.col("packet_size"))
    )
    time = F.when(F.col("traffic_type") != "view", F.col("log_time"))
    return traffic(spark, folder).withColumns({"packet_size": size, "log_time": time})


def results(spark: SparkSession, folder: str) -> DataFrame:
    """The size detector's rows as anomaly results."""
    t = traffic(spark, folder)
    score = (F.lit(100.0) - F.col("packet_size")) / 100.0
    return t.select(
        F.col("id").alias("original_id"),
        "log_time",
        score.alias("anomaly_score"),
        F.when(F.col("packet_size") > 80, 1).otherwise(0).alias("is_anomaly"),
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """True and predicted label per traffic row: an error is the positive class."""
    t = traffic(spark, folder)
    return t.select(
        "id",
        "log_time",
        "packet_size",
        F.when(F.col("traffic_type") == "error", 1).otherwise(0).alias("label"),
        F.when(F.col("packet_size") > 100, 1).otherwise(0).alias("predicted_label"),
    )


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """One session per order: the line items are its traffic, in (open lines) and out (closed lines)."""
    lines = table(spark, folder, "lineitem")
    inward = F.col("l_linestatus") == "O"

    def total(amount: str, side):
        return F.coalesce(F.sum(F.when(side, F.col(amount))), F.lit(0.0))

    per_order = lines.groupBy("l_orderkey").agg(
        total("l_quantity", inward).alias("PktPerSesIn"),
        total("l_quantity", ~inward).alias("PktPerSesOut"),
        total("l_extendedprice", inward).alias("BPerSesIn"),
        total("l_extendedprice", ~inward).alias("BPerSesOut"),
        F.max("l_shipdate").alias("TSesEnd"),
    )
    orders = table(spark, folder, "orders")
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    zero = F.lit(0.0)
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("srcIP"),
        F.col("o_orderstatus").alias("dstIP"),
        F.lit(0).alias("srcPort"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("dstPort"),
        F.col("o_orderdate").alias("TSesStart"),
        "TSesEnd",
        fx.seconds_between(F.col("o_orderdate"), F.col("TSesEnd")).alias("SessDuration"),
        F.coalesce("PktPerSesIn", zero).alias("PktPerSesIn"),
        F.coalesce("PktPerSesOut", zero).alias("PktPerSesOut"),
        F.coalesce("BPerSesIn", zero).alias("BPerSesIn"),
        F.coalesce("BPerSesOut", zero).alias("BPerSesOut"),
        F.col("o_totalprice").alias("total_price"),
    )


def session_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Scores per session; costly sessions are scored a second time later, so the newest must win."""
    o = table(spark, folder, "orders")
    first = o.select(
        F.col("o_orderkey").alias("session_id"),
        F.lit("isolation_forest").alias("model_type"),
        F.when(F.col("o_totalprice") > 300000, 1).otherwise(0).alias("prediction"),
        ((F.lit(300000.0) - F.col("o_totalprice")) / 300000.0).alias("anomaly_score"),
        F.col("o_orderdate").alias("log_time"),
    )
    again = first.filter(F.col("anomaly_score") < -0.25).select(
        "session_id",
        "model_type",
        F.lit(1).alias("prediction"),
        (F.col("anomaly_score") - 0.5).alias("anomaly_score"),
        (F.col("log_time") + F.expr("interval 1 day")).alias("log_time"),
    )
    both = first.unionByName(again)
    return both.withColumns(
        {"is_anomaly": F.col("prediction"), "traffic_type": fx.traffic_label(F.col("prediction"))}
    )


def performance_history(spark: SparkSession, folder: str) -> DataFrame:
    """One evaluation record per day of traffic."""
    rows = labelled(spark, folder).withColumn("day", F.to_date("log_time"))
    daily = weighted_scores(rows, "label", "predicted_label", by=("day",))
    return daily.withColumn("timestamp", F.col("day").cast("timestamp_ntz")).drop("day")


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """One run record per day of traffic; a day fails when its largest packet exceeds 300."""
    t = traffic(spark, folder)
    daily = t.groupBy(F.to_date("log_time").alias("day")).agg(
        F.min("log_time").alias("start_time"),
        F.max("log_time").alias("end_time"),
        F.max("packet_size").alias("largest"),
        F.count("*").alias("n"),
    )
    return daily.select(
        F.date_format("day", "yyyyMMdd").alias("run_id"),
        F.col("day").cast("timestamp_ntz").alias("timestamp"),
        F.when(F.weekday("day") < 5, "supervised").otherwise("unsupervised").alias("mode"),
        fx.seconds_between(F.col("start_time"), F.col("end_time")).alias("execution_time_seconds"),
        (F.col("largest") <= 300).alias("success"),
        F.col("n").alias("data_rows"),
    )
