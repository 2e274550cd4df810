"""Hourly rollups, spines, distributions, histograms, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx
from trafficlens.operators.ordering import exact_quantiles

HISTOGRAM_BINS = 50  # fixed value
SKETCH_BITS = 15  # 32,768 registers: a standard error of 0.6 %, at most 32 KB per sketch


def _hour(df: DataFrame, time_column: str) -> Column:
    return fx.hour_of(F.col(time_column), df.schema[time_column].dataType.simpleString())


def hour_spine(df: DataFrame, time_column: str, output: str = "hour") -> DataFrame:
    """Every hour from the first to the last row. Size is the time span, not the row count."""
    kind = df.schema[time_column].dataType.simpleString()
    span = df.agg(F.min(time_column).alias("first"), F.max(time_column).alias("last"))
    hours = F.sequence(
        F.date_trunc("hour", "first"), F.date_trunc("hour", "last"), F.expr("interval 1 hour")
    )
    present = span.filter(F.col("first").isNotNull())
    return present.select(F.explode(hours.cast(f"array<{kind}>")).alias(output))


def hourly_features(
    df: DataFrame,
    time_column: str = "timestamp",
    size: str = "packet_size",
    source: str = "source_ip",
    dest: str = "dest_ip",
) -> DataFrame:
    """Count, mean, sample deviation, extremes and distinct endpoints per hour.

    Empty hours appear, and undefined values are 0. Rows without a time belong to no hour; NaN and
    infinite sizes count as missing. The raw rows shuffle once as
    partial aggregates; only the hourly rows join the spine.
    """
    value = fx.number_of(df, size)
    per_hour = df.groupBy(_hour(df, time_column).alias("hour")).agg(
        F.count(value).alias("packet_count"),
        F.avg(value).alias("avg_packet_size"),
        F.stddev_samp(value).alias("std_packet_size"),
        F.min(value).alias("min_packet_size"),
        F.max(value).alias("max_packet_size"),
        F.count_distinct(source).alias("unique_source_ips"),
        F.count_distinct(dest).alias("unique_dest_ips"),
    )
    joined = hour_spine(df, time_column).join(per_hour, "hour", "left")
    return joined.fillna(0)


def hourly_sketches(df: DataFrame, time_column: str, source: str, dest: str, bits: int = SKETCH_BITS) -> DataFrame:
    """Row count and mergeable sketches of the distinct endpoints per hour.

    Sketches of parts of the rows add up by :func:`merge_sketches`, where the exact counts of
    :func:`hourly_features` need all rows again. Missing endpoints are not counted; an hour without
    any has a NULL sketch. Rows without a time belong to no hour.
    """
    return df.filter(F.col(time_column).isNotNull()).groupBy(_hour(df, time_column).alias("hour")).agg(
        F.count("*").alias("row_count"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(name) for c, name in ((source, "source_sketch"), (dest, "dest_sketch"))],
    )


def merge_sketches(hours: DataFrame, unit: str = "day") -> DataFrame:
    """Sketched hours, of any number of loads, as rows per hour, day, month or year; rows are not read again."""
    kind = hours.schema["hour"].dataType.simpleString()
    return hours.groupBy(F.date_trunc(unit, "hour").cast(kind).alias(unit)).agg(
        F.sum("row_count").alias("row_count"),
        *[F.hll_union_agg(name).alias(name) for name in ("source_sketch", "dest_sketch")],
    )


def sketch_counts(merged: DataFrame) -> DataFrame:
    """Sketches as estimated numbers of distinct endpoints; 0 where there is none."""
    counts = {f"unique_{side}s": F.coalesce(F.hll_sketch_estimate(f"{side}_sketch"), F.lit(0)) for side in ("source", "dest")}
    return merged.withColumns(counts).drop("source_sketch", "dest_sketch")


def hourly_metrics(df: DataFrame, time_column: str, columns: Sequence[str], row_id: str = "id") -> DataFrame:
    """Mean, sum and count of each metric plus the session count, per hour, in one exact pass."""
    aggregates = []
    for c in columns:
        value = fx.number_of(df, c)
        aggregates += [F.avg(value).alias(f"{c}_mean"), F.sum(value).alias(f"{c}_sum"), F.count(value).alias(f"{c}_count")]
    aggregates.append(F.count(row_id).alias("session_count"))
    return df.groupBy(_hour(df, time_column).alias("hour")).agg(*aggregates)


def hourly_resample(df: DataFrame, time_column: str, column: str) -> DataFrame:
    """Hourly mean; hours without rows are NULL."""
    means = df.groupBy(_hour(df, time_column).alias("hour")).agg(F.avg(fx.number_of(df, column)).alias(f"mean_{column}"))
    return hour_spine(df, time_column).join(means, "hour", "left")


def hourly_gaps(df: DataFrame, covered: DataFrame, time_column: str, covered_time: str) -> DataFrame:
    """Hours in the span of ``df`` for which ``covered`` has no row."""
    done = covered.select(_hour(covered, covered_time).alias("hour")).distinct()
    return hour_spine(df, time_column).join(done, "hour", "left_anti")


def backfill_hours(first_missing: str, last: str, spark) -> DataFrame:
    """One deterministic row per hour between two times, both included; none if they are reversed."""
    bounds = spark.range(1).select(
        F.date_trunc("hour", F.lit(first_missing).cast("timestamp")).alias("a"),
        F.date_trunc("hour", F.lit(last).cast("timestamp")).alias("b"),
    )
    # A sequence must not run backwards, so reversed bounds are cut off after it.
    span = F.expr("sequence(a, greatest(a, b), interval 1 hour)")
    hours = bounds.select("b", F.explode(span).alias("timestamp")).filter("timestamp <= b")
    h = F.hour("timestamp")
    return hours.select(
        fx.hour_source_ip(h).alias("source_ip"),
        fx.hour_dest_ip(h).alias("dest_ip"),
        "timestamp",
        fx.hour_packet_size(h).alias("packet_size"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count per value and its share of all rows in percent."""
    counts = df.groupBy(column).agg(F.count("*").alias("row_count"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("share_percent", F.round(fx.percent(F.col("row_count"), total), 4))


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin includes the maximum.

    Bins without rows are present with count 0. A constant column spans half a unit each side.
    """
    value = fx.clean_number(F.col(column))
    span = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("span")).scalar()
    flat = span.getField("low") == span.getField("high")
    low = F.when(flat, span.getField("low") - 0.5).otherwise(span.getField("low"))
    high = F.when(flat, span.getField("high") + 0.5).otherwise(span.getField("high"))
    width = (high - low) / F.lit(bins)
    slot = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(value.isNotNull()).groupBy(slot.alias("bin")).agg(F.count("*").alias("row_count"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        (low + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


def size_histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Histogram with the column's mean and exact median on every row, as a chart needs them."""
    mean = df.agg(F.avg(fx.number_of(df, column)).alias("mean")).scalar()
    median = exact_quantiles(df, column, [0.5])[0]
    return histogram(df, column, bins).withColumns(
        {"mean_value": mean, "median_value": F.lit(median).cast("double")}
    )


def summary_stats(flags: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """Total, anomalies, normals and anomaly percentage (0 when empty) from one scan."""
    anomalies = F.count_if(F.col(flag) == 1)
    return flags.agg(F.count("*").alias("total_records"), anomalies.alias("anomaly_count")).select(
        "total_records",
        "anomaly_count",
        (F.col("total_records") - F.col("anomaly_count")).alias("normal_count"),
        fx.percent(F.col("anomaly_count"), F.col("total_records")).alias("anomaly_percentage"),
    )


def summary_extended(results: DataFrame, labels: DataFrame) -> DataFrame:
    """Summary with score range and model accuracy.

    ``results`` has original_id, anomaly_score, is_anomaly; ``labels`` has original_id, label,
    predicted_label. Both reduce to one row before they meet. NaN and infinite scores count as missing.
    """
    score = fx.number_of(results, "anomaly_score")
    scores = results.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        F.count_if(F.col("is_anomaly") == 0).alias("normal_count"),
        F.avg(score).alias("avg_anomaly_score"),
        F.min(score).alias("min_anomaly_score"),
        F.max(score).alias("max_anomaly_score"),
    )
    checked = labels.agg(
        F.struct(
            F.count("*").alias("n"),
            F.count_if(F.col("label") == F.col("predicted_label")).alias("right"),
        ).alias("c")
    ).scalar()
    return scores.withColumns(
        {
            "supervised_predictions": checked.getField("n"),
            "anomaly_percentage": F.round(fx.percent(F.col("anomaly_count"), F.col("total_records")), 2),
            "model_accuracy": F.round(fx.percent(checked.getField("right"), checked.getField("n")), 2),
        }
    )


def score_audit(df: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """Row count, score range and number of missing scores, NaN and infinite ones among them."""
    value = fx.number_of(df, score)
    return df.agg(
        F.count("*").alias("row_count"),
        F.min(value).alias("min_score"),
        F.max(value).alias("max_score"),
        F.count_if(value.isNull()).alias("missing_scores"),
    )


def hourly_predictions(df: DataFrame, time_column: str, cut: float = 0.5) -> DataFrame:
    """Mean prediction and score per hour; an hour is anomalous above the cut."""
    per_hour = df.groupBy(_hour(df, time_column).alias("hour")).agg(
        F.avg("prediction").alias("mean_prediction"), F.avg(fx.number_of(df, "anomaly_score")).alias("supervised_score")
    )
    flag = F.when(F.col("mean_prediction") > cut, 1).otherwise(0)
    return per_hour.select(
        "hour",
        flag.alias("supervised_prediction"),
        "supervised_score",
        fx.traffic_label(flag).alias("supervised_label"),
    )


def hybrid_hours(unsupervised: DataFrame, supervised: DataFrame) -> DataFrame:
    """Combine hourly detector output with hourly supervised output.

    The supervised result is final where it exists, the unsupervised one elsewhere;
    ``ensemble_confidence`` is the mean of the predictions that exist.
    """
    joined = unsupervised.join(supervised, "hour", "left")
    own, other = F.col("prediction"), F.col("supervised_prediction")
    final = F.coalesce(other, own)
    return joined.withColumns(
        {
            "final_prediction": final,
            "final_label": fx.traffic_label(final),
            "final_score": F.coalesce("supervised_score", "anomaly_score"),
            "ensemble_confidence": F.when(other.isNull(), own.cast("double")).otherwise((own + other) / 2.0),
        }
    )
