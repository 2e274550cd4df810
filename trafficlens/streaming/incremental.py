"""Incremental scoring and hourly rollups with Structured Streaming.

A scheduler starts these jobs; each run takes what has arrived and stops
(``availableNow``), and the checkpoint remembers what was processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trafficlens.functions import columns as fx
from trafficlens.operators.iforest import IsolationForest, score_forest


def read_new_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def with_event_time(df: DataFrame, time_column: str, delay: str) -> DataFrame:
    """Watermarked event time; zone-less timestamps are read in the session time zone."""
    return df.withColumn(time_column, F.col(time_column).cast("timestamp")).withWatermark(time_column, delay)


def hourly_stream(df: DataFrame, time_column: str, size: str, delay: str = "2 hours") -> DataFrame:
    """Tumbling hourly count, mean, sum and extremes; closed hours equal the batch rollup.

    NaN and infinite sizes count as missing, and rows without a time belong to no hour.
    """
    timed = with_event_time(df, time_column, delay)
    value = fx.number_of(timed, size)
    hours = timed.groupBy(F.window(time_column, "1 hour").alias("w")).agg(
        F.count(value).alias("packet_count"),
        F.avg(value).alias("avg_packet_size"),
        F.sum(value).alias("total_packet_size"),
        F.min(value).alias("min_packet_size"),
        F.max(value).alias("max_packet_size"),
    )
    return hours.select(F.col("w.start").alias("hour"), *[c for c in hours.columns if c != "w"])


def run_hourly(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed hours to a Parquet folder."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_hours(stream: DataFrame, path: str, checkpoint: str, time_column: str, size: str) -> StreamingQuery:
    """Keep hourly counts, sums and extremes under ``path`` up to date, late rows included.

    Every micro-batch writes its own partial sums into its own folder, so a batch that is retried
    replaces itself, and no hour is ever closed: rows of any age correct theirs. Read with :func:`read_hours`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        partial_hours(batch, time_column, size).write.mode("overwrite").parquet(f"{path}/batches/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_PARTS = {"packet_count": F.sum, "total_packet_size": F.sum, "min_packet_size": F.min, "max_packet_size": F.max}


def partial_hours(df: DataFrame, time_column: str, size: str) -> DataFrame:
    """What adds up: count, sum and extremes per hour; rows without a time belong to no hour."""
    value = fx.number_of(df, size).cast("double")
    hour = fx.hour_of(F.col(time_column), df.schema[time_column].dataType.simpleString())
    return df.filter(F.col(time_column).isNotNull()).groupBy(hour.alias("hour")).agg(
        F.count(value).alias("packet_count"), F.sum(value).alias("total_packet_size"), F.min(value).alias("min_packet_size"), F.max(value).alias("max_packet_size"))


def _stored_hours(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    """Partial sums: those merged last, and of the batches since; with the number of the newest batch."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(pattern: str) -> list[int]:
        found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}/_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    merged, batches = numbers("merged/upto=*"), numbers("batches/batch=*")
    upto = merged[-1] if merged else -1
    parts = [f"{path}/merged/upto={upto}"] * bool(merged) + [f"{path}/batches/batch={b}" for b in batches if b > upto]
    if not parts:
        raise ValueError(f"no hours are stored under {path}")
    # A list of whole folders, so that no partition column is made of their names.
    frames = spark.read.option("recursiveFileLookup", True).parquet(*parts)
    return frames, max([upto, *batches])


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("hour").agg(*[add(name).alias(name) for name, add in _PARTS.items()])


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hourly table as it would be after one pass over all rows seen so far."""
    hours = _summed(_stored_hours(spark, path)[0])
    return hours.withColumn("avg_packet_size", F.try_divide("total_packet_size", "packet_count"))


def compact_hours(spark: SparkSession, path: str) -> None:
    """Merge the partial sums of all batches into one table; readers change over when it is complete."""
    parts, newest = _stored_hours(spark, path)
    _summed(parts).write.mode("overwrite").parquet(f"{path}/merged/upto={newest}")


def prediction_rows(scored: DataFrame, id_column: str, time_column: str, model_type: str) -> DataFrame:
    """Scored rows in the layout of the predictions table."""
    score = F.col("anomaly_score")
    return scored.select(
        F.col(id_column).cast("long").alias("session_id"),
        F.lit(model_type).alias("model_type"),
        "prediction",
        "anomaly_score",
        F.lit(None).cast("double").alias("confidence_score"),
        "traffic_type",
        F.col("prediction").alias("is_anomaly"),
        fx.risk_band(score).alias("risk_level"),
        F.col(time_column).cast("timestamp").alias("log_time"),
    )


def score_new_rows(
    stream: DataFrame,
    model: IsolationForest,
    path: str,
    checkpoint: str,
    id_column: str = "id",
    time_column: str = "log_time",
    model_type: str = "isolation_forest",
) -> StreamingQuery:
    """Score rows that arrived since the last run with a frozen model.

    Every micro-batch overwrites its own folder, so a batch that is retried after a
    failure leaves no duplicates. Read the result with :func:`read_scored`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prediction_rows(score_forest(batch, model), id_column, time_column, model_type)
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")
