"""Sinks: replace, append with quarantine, CSV export, run log and metric history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.sources.schemas import layout


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table in one committed job. Never pass a frame that reads ``path``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_catalog_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def append_with_quarantine(df: DataFrame, path: str, quarantine_path: str, required: Sequence[str]) -> None:
    """Append rows whose required columns are all present; the rest go to a quarantine table."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    append_table(df.filter(complete), path)
    append_table(df.filter(~complete), quarantine_path)


def write_predictions(df: DataFrame, path: str, mode: str = "append") -> None:
    """Prediction rows laid out by event date, so date filters prune folders."""
    dated = df.withColumn("event_date", F.to_date("log_time"))
    dated.write.mode(mode).partitionBy("event_date").parquet(path)


#: Times in text keep their microseconds.
TIME_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(header=True, sep=sep, **TIME_TEXT).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(header=True, **TIME_TEXT).csv(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    mode: str,
    start: datetime,
    end: datetime,
    success: bool,
    steps: Sequence[str] = (),
    error: str | None = None,
    metrics: dict[str, float] | None = None,
    stats: dict[str, str] | None = None,
) -> None:
    """Append one run record as a JSON line."""
    record = (
        run_id,
        datetime.now(timezone.utc),
        mode,
        start,
        end,
        (end - start).total_seconds(),
        success,
        list(steps),
        error,
        {k: float(v) for k, v in (metrics or {}).items()},
        {k: str(v) for k, v in (stats or {}).items()},
    )
    append_json(spark.createDataFrame([record], layout("pipeline_runs")).coalesce(1), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(layout("pipeline_runs")).json(path)


def append_metrics(record: DataFrame, path: str) -> None:
    """Append performance records (a few rows per run) to the JSON metric history."""
    append_json(record.coalesce(1), path)


def read_metrics(spark: SparkSession, path: str, keep: int = 100) -> DataFrame:
    """The newest ``keep`` performance records."""
    history = spark.read.schema(layout("performance_history")).json(path)
    return history.orderBy(F.col("timestamp").desc()).limit(keep)


def write_json_summary(summary: DataFrame, path: str) -> None:
    """One-row summary as JSON."""
    summary.coalesce(1).write.mode("overwrite").json(path)
