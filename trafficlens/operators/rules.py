"""Rule and z-score detectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx

# Default rule thresholds.
LARGE_PACKET = 4500
SMALL_PACKET = 50
RAPID_GAP_SECONDS = 0.1
Z_LIMIT = 3.0
LOST_GROUPS = 4096


def zscore_flags(df: DataFrame, columns: Sequence[str], threshold: float = Z_LIMIT) -> DataFrame:
    """Flag rows further than ``threshold`` sample deviations from the mean in any column.

    A flagged row's prediction becomes 1; others keep theirs (0 / 'normal' when the
    input has none). A zero or undefined deviation flags nothing. NaN and infinities count
    as missing.
    """
    present = [c for c in columns if c in df.columns]
    out = df
    if "prediction" not in df.columns:
        out = out.withColumn("prediction", F.lit(0))
    if "traffic_type" not in df.columns:
        out = out.withColumn("traffic_type", F.lit("normal"))
    if not present:
        return out
    number = {c: fx.clean_number(fx.named(c)) for c in present}
    stats = df.agg(
        F.struct(
            *[F.avg(v).alias(f"m_{c}") for c, v in number.items()],
            *[F.stddev_samp(v).alias(f"s_{c}") for c, v in number.items()],
        ).alias("stats")
    ).scalar()
    flags = {}
    for c, v in number.items():
        spread = stats.getField(f"s_{c}")
        distance = F.try_divide(F.abs(v - stats.getField(f"m_{c}")), spread)
        flags[f"{c}_anomaly"] = F.coalesce(distance > threshold, F.lit(False))
    out = out.withColumns(flags)
    any_flag = reduce(lambda a, b: a | b, [fx.named(name) for name in flags])
    out = out.withColumn("statistical_anomaly", any_flag)
    hit = F.col("statistical_anomaly")
    return out.withColumns(
        {
            "prediction": F.when(hit, 1).otherwise(F.col("prediction")),
            "traffic_type": F.when(hit, "anomaly").otherwise(F.col("traffic_type")),
        }
    )


def interarrival(
    df: DataFrame,
    source: str,
    time_column: str,
    tie_breaker: str,
    output: str = "diff_seconds",
    slice_seconds: int = 900,
) -> DataFrame:
    """Seconds since the previous row of the same source; the first row gets 0, as do rows
    without a source or a time.

    Rows are grouped by source and time slice, so one busy source is spread over many
    tasks. Each slice also receives one marker row holding the source's last instant
    before it, taken from a map-side combined table of (source, slice) maxima. The
    marker sorts first, so the lag inside the slice finds it and no join is needed.
    Choose a shorter slice when a source is denser than one task can sort.
    """
    micros = F.unix_micros(F.col(time_column).cast("timestamp"))
    sliced = df.withColumns(
        {
            "_at": micros,
            "_slice": F.floor(micros / F.lit(slice_seconds * 1_000_000)),
            "_marker": F.lit(False),
        }
    )
    # Rows without a source or a time have no neighbours; dealt out by hash, they form no large group.
    lost = F.col(source).isNull() | micros.isNull()
    sliced = sliced.withColumns(
        {"_lost": F.when(lost, F.pmod(F.xxhash64(tie_breaker), F.lit(LOST_GROUPS))), "_slice": F.when(~lost, F.col("_slice"))}
    )
    by_source = Window.partitionBy(source).orderBy("_slice")
    markers = (
        sliced.filter(F.col("_lost").isNull())
        .groupBy(source, "_slice")
        .agg(F.max("_at").alias("_last"))
        .select(source, "_slice", F.lag("_last").over(by_source).alias("_at"), F.lit(True).alias("_marker"))
        .filter(F.col("_at").isNotNull())
    )
    in_slice = Window.partitionBy(source, "_slice", "_lost").orderBy("_at", tie_breaker)
    previous = sliced.unionByName(markers, allowMissingColumns=True).withColumn(
        "_previous", F.lag("_at").over(in_slice)
    )
    gap = F.when(F.col("_lost").isNull(), (F.col("_at") - F.col("_previous")) / F.lit(1e6))
    rows = previous.filter(~F.col("_marker")).withColumn(output, F.coalesce(gap, F.lit(0.0)))
    return rows.drop("_at", "_slice", "_marker", "_previous", "_lost")


def rule_labels(
    df: DataFrame,
    source: str = "source_ip",
    time_column: str = "timestamp",
    size: str = "packet_size",
    tie_breaker: str = "id",
    large: float = LARGE_PACKET,
    small: float = SMALL_PACKET,
    rapid: float = RAPID_GAP_SECONDS,
    slice_seconds: int = 900,
) -> DataFrame:
    """Label large, small and rapid packets: ``anomaly_flag`` 0/1, score -1/1, text label."""
    timed = interarrival(df, source, time_column, tie_breaker, slice_seconds=slice_seconds)
    return label_gaps(timed, size, large, small, rapid)


def label_gaps(
    timed: DataFrame, size: str = "packet_size", large: float = LARGE_PACKET, small: float = SMALL_PACKET, rapid: float = RAPID_GAP_SECONDS
) -> DataFrame:
    """The labels of rows whose gap to the former row of their source is in ``diff_seconds``."""
    gap = F.col("diff_seconds")
    bytes_ = fx.not_nan(F.col(size))
    hit = (bytes_ > large) | (bytes_ < small) | ((gap > 0) & (gap < rapid))
    flag = F.coalesce(hit, F.lit(False)).cast("int")
    return timed.withColumns(
        {
            "anomaly_flag": flag,
            "anomaly_score": F.when(flag == 1, -1).otherwise(1),
            "traffic_type": fx.traffic_label(flag),
        }
    )
