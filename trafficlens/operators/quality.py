"""Counts, reconciliation, referential checks, alignment, frame profile."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions import columns as fx


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table; Parquet counts come from file footers."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target row counts and whether they agree."""
    wanted = target.agg(F.count("*").alias("n")).scalar()
    return source.agg(F.count("*").alias("source_rows")).select(
        "source_rows",
        wanted.alias("target_rows"),
        (F.col("source_rows") == wanted).alias("counts_match"),
    )


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent; only the parent's key column is read."""
    keys = parents.select(F.col(parent_key).alias("_key"))
    return children.join(keys, F.col(child_key) == F.col("_key"), "left_anti")


def newest_predictions(predictions: DataFrame, keys=("session_id", "model_type"), time_column: str = "log_time"):
    """The newest row per session and model.

    A maximum over (time, row) combines map-side, so a session scored many times
    never gathers in one task, unlike a window sort.
    """
    rest = [c for c in predictions.columns if c not in keys and c != time_column]
    newest = F.max(F.struct(time_column, *rest)).alias("_newest")
    return predictions.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*predictions.columns)


def labels_by_time(traffic: DataFrame, labels: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Traffic rows with the label of the same instant.

    Labels are reduced to one per instant first (anomalous if any is), so equal
    timestamps never multiply rows.
    """
    per_instant = labels.groupBy(time_column).agg(F.max("prediction").alias("prediction"))
    return traffic.join(per_instant, time_column)


def alignment_audit(
    traffic: DataFrame,
    predictions: DataFrame,
    traffic_time: str,
    prediction_time: str,
    size: str,
    threshold: float,
) -> DataFrame:
    """Row counts of both tables, number of shared hours, and anomalies on each side.

    An infinite size is above the threshold, a NaN one unknown.
    """
    t_kind = traffic.schema[traffic_time].dataType.simpleString()
    p_kind = predictions.schema[prediction_time].dataType.simpleString()
    t_hours = traffic.select(fx.hour_of(F.col(traffic_time), t_kind).alias("hour")).distinct()
    p_hours = predictions.select(fx.hour_of(F.col(prediction_time), p_kind).alias("hour")).distinct()
    aligned = t_hours.join(p_hours, "hour", "left_semi").agg(F.count("*").alias("n")).scalar()
    right = predictions.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col("prediction") == 1).alias("bad")).alias("p")
    ).scalar()
    left = traffic.agg(
        F.count("*").alias("traffic_rows"), F.count_if(fx.not_nan(F.col(size)) > threshold).alias("traffic_anomalies")
    )
    return left.select(
        "traffic_rows",
        right.getField("n").alias("prediction_rows"),
        aligned.alias("aligned_hours"),
        "traffic_anomalies",
        right.getField("bad").alias("prediction_anomalies"),
    )


def frame_profile(df: DataFrame) -> DataFrame:
    """Row count, column count and column names of a frame."""
    return df.agg(F.count("*").alias("row_count")).withColumns(
        {
            "column_count": F.lit(len(df.columns)),
            "column_names": F.lit(",".join(df.columns)),
        }
    )


def numeric_profile(df: DataFrame, exclude: tuple[str, ...] = ("id",)) -> DataFrame:
    """Per numeric column: non-null count, mean, minimum, maximum; one scan."""
    skip = {e.lower() for e in exclude}
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name.lower() not in skip]
    if not names:
        raise ValueError("no numeric columns")

    def cell(name: str):
        v = fx.clean_number(fx.named(name))
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(v).alias("value_count"),
            F.avg(v).alias("mean_value"),
            F.min(v).alias("min_value"),
            F.max(v).alias("max_value"),
        )

    return df.agg(F.array(*[cell(n) for n in names]).alias("cells")).select(F.inline("cells"))
