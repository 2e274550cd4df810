"""Model monitoring and run-log reports. Histories hold one row per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.functions.columns import ratio
from trafficlens.operators.evaluation import weighted_scores

WINDOW = 10  # fixed value: records in a trend
RETRAIN_DROP = 0.05  # fixed value


def performance_record(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One history row for the current evaluation."""
    return weighted_scores(df, label, prediction).select(
        F.current_timestamp().alias("timestamp"), "accuracy", "precision", "recall", "f1_score", "sample_size"
    )


def _recent(history: DataFrame, window: int) -> DataFrame:
    """The newest ``window`` records, numbered 0.. in time order (at most ``window`` rows)."""
    newest = history.orderBy(F.col("timestamp").desc()).limit(window)
    return newest.withColumn("_x", F.row_number().over(Window.orderBy("timestamp")) - 1)


def metric_trend(history: DataFrame, window: int = WINDOW) -> DataFrame:
    """Latest value, mean, population deviation and slope of accuracy and F1.

    No row when the history is shorter than the window.
    """

    def parts(metric: str, name: str):
        return [
            F.max_by(metric, "_x").alias(f"current_{name}"),
            F.avg(metric).alias(f"avg_{name}"),
            F.stddev_pop(metric).alias(f"{name}_std"),
            F.regr_slope(metric, "_x").alias(f"{name}_trend"),
        ]

    trend = _recent(history, window).agg(
        F.count("*").alias("_n"), *parts("accuracy", "accuracy"), *parts("f1_score", "f1")
    )
    return trend.filter(F.col("_n") == window).drop("_n")


def retrain_decision(history: DataFrame, threshold: float = RETRAIN_DROP, window: int = WINDOW) -> DataFrame:
    """Whether accuracy or F1 fell more than ``threshold`` below its recent mean; false without enough history."""
    recent = _recent(history, window).agg(
        F.count("*").alias("records"),
        F.max_by("accuracy", "_x").alias("current_accuracy"),
        F.avg("accuracy").alias("avg_accuracy"),
        F.max_by("f1_score", "_x").alias("current_f1"),
        F.avg("f1_score").alias("avg_f1"),
    )
    worse = (F.col("current_accuracy") < F.col("avg_accuracy") - threshold) | (
        F.col("current_f1") < F.col("avg_f1") - threshold
    )
    needed = (F.col("records") == window) & F.coalesce(worse, F.lit(False))
    return recent.withColumn("retrain", needed)


def monitoring_summary(history: DataFrame, window: int = WINDOW, threshold: float = RETRAIN_DROP) -> DataFrame:
    """Run count, latest record, trend and retraining decision in one row; no trend without enough history."""
    trend = metric_trend(history, window)
    decision = retrain_decision(history, threshold, window).select("retrain").scalar()
    latest = F.max(
        F.struct("timestamp", "accuracy", "precision", "recall", "f1_score", "sample_size")
    ).alias("latest")
    return history.agg(F.count("*").alias("total_runs"), latest).select(
        "total_runs", "latest.*", decision.alias("retraining_needed"),
        *[trend.select(name).scalar().alias(name) for name in ("accuracy_trend", "f1_trend")],
    )


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    """The newest ``limit`` runs."""
    return runs.orderBy(F.col("timestamp").desc()).limit(limit)


def run_log_summary(runs: DataFrame) -> DataFrame:
    """Totals, success rate, mean duration and runs per mode in one scan."""
    totals = runs.agg(
        F.count("*").alias("total_runs"),
        F.count_if("success").alias("successful_runs"),
        F.count_if(~F.col("success")).alias("failed_runs"),
        F.coalesce(F.avg("execution_time_seconds"), F.lit(0.0)).alias("average_execution_time"),
        F.count_if(F.col("mode") == "supervised").alias("supervised_runs"),
        F.count_if(F.col("mode") == "unsupervised").alias("unsupervised_runs"),
        F.max_by("run_id", "timestamp").alias("last_run"),
    )
    return totals.withColumn("success_rate", ratio(F.col("successful_runs"), F.col("total_runs")))


def run_report(runs: DataFrame, flags: DataFrame, metrics: DataFrame) -> DataFrame:
    """Daily report row: the last run, model metrics and anomaly counts.

    Each part is a one-row aggregate and is attached as a scalar.
    """
    last = runs.agg(
        F.max(
            F.struct("timestamp", "run_id", "mode", "execution_time_seconds", "success")
        ).alias("last")
    ).select("last.run_id", "last.mode", "last.execution_time_seconds", "last.success")
    quality = metrics.agg(
        F.first(F.struct("accuracy", "precision", "recall", "f1_score")).alias("m")
    ).scalar()
    counts = flags.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col("is_anomaly") == 1).alias("bad")).alias("c")
    ).scalar()
    return last.withColumns(
        {
            "accuracy": quality.getField("accuracy"),
            "precision": quality.getField("precision"),
            "recall": quality.getField("recall"),
            "f1_score": quality.getField("f1_score"),
            "data_rows": counts.getField("n"),
            "anomaly_count": counts.getField("bad"),
            "anomaly_percentage": F.round(ratio(counts.getField("bad") * 100, counts.getField("n")), 2),
        }
    )


# Lines of the text report and the report column each one shows.
REPORT_LINES = (
    ("Run: %s", "run_id"),
    ("Mode: %s", "mode"),
    ("Execution time: %.2f seconds", "execution_time_seconds"),
    ("Success: %s", "success"),
    ("Accuracy: %.4f", "accuracy"),
    ("Precision: %.4f", "precision"),
    ("Recall: %.4f", "recall"),
    ("F1 score: %.4f", "f1_score"),
    ("Rows: %d", "data_rows"),
    ("Anomalies: %d", "anomaly_count"),
    ("Anomaly percentage: %.2f%%", "anomaly_percentage"),
)


def report_text(report: DataFrame) -> DataFrame:
    """The daily report as numbered text lines, ready for a text or CSV sink."""
    lines = [
        F.struct(F.lit(i).alias("line"), F.format_string(text, F.col(column)).alias("value"))
        for i, (text, column) in enumerate(REPORT_LINES)
    ]
    return report.select(F.inline(F.array(*lines)))
