"""Session, calendar and label features, standard scaling, full preprocessing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx
from trafficlens.operators.cleaning import clean_rows
from trafficlens.operators.encoding import label_encode
from trafficlens.session import materialize
from trafficlens.sources.schemas import require_columns


def session_features(
    df: DataFrame,
    start: str,
    end: str,
    packets_in: str | None = None,
    packets_out: str | None = None,
    total_bytes: str | None = None,
) -> DataFrame:
    """Duration in seconds, packet rate and bytes per second; a zero duration counts as 1 s.

    A rate is added only when its input columns are named.
    """
    require_columns(df, start, end)
    out = df.withColumn("session_duration", fx.seconds_between(F.col(start), F.col(end)))
    added = {}
    if packets_in and packets_out:
        added["packet_rate"] = fx.per_second(F.col(packets_in) + F.col(packets_out), F.col("session_duration"))
    if total_bytes:
        added["bytes_per_session"] = fx.per_second(F.col(total_bytes), F.col("session_duration"))
    return out.withColumns(added) if added else out


def calendar_features(df: DataFrame, time_column: str) -> DataFrame:
    return df.withColumns(fx.calendar_columns(F.col(time_column)))


def anonymize(df: DataFrame, columns: Sequence[str] = ("source_ip",)) -> DataFrame:
    """Replace the named columns, where present, by their SHA-256 hex."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: fx.anonymized(F.col(c)) for c in present})


def status_label(df: DataFrame, code: str = "response_code", label: str = "label") -> DataFrame:
    require_columns(df, code)
    return df.withColumn(label, fx.status_flag(F.col(code)))


def hour_attributes(df: DataFrame, time_column: str) -> DataFrame:
    """Packet size and addresses that follow from the hour of day alone."""
    hour = F.hour(time_column)
    return df.withColumns(
        {
            "packet_size": fx.hour_packet_size(hour),
            "source_ip": fx.hour_source_ip(hour),
            "dest_ip": fx.hour_dest_ip(hour),
        }
    )


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Centre and divide by the population deviation; a constant column is divided by 1. NaN and
    infinities count as missing.

    Means and deviations arrive as one scalar subquery over the same input.
    """
    value = {c: fx.clean_number(fx.named(c)) for c in columns}
    stats = df.agg(
        F.struct(
            *[F.avg(v).alias(f"m_{c}") for c, v in value.items()],
            *[F.stddev_pop(v).alias(f"s_{c}") for c, v in value.items()],
        ).alias("stats")
    ).scalar()

    def scaled(c: str):
        deviation = stats.getField(f"s_{c}")
        return (value[c] - stats.getField(f"m_{c}")) / F.when(deviation == 0, 1.0).otherwise(deviation)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def preprocess(
    df: DataFrame,
    time_column: str = "log_time",
    address_columns: Sequence[str] = ("source_ip",),
    code: str = "response_code",
    encode: Sequence[str] = (),
    scale: Sequence[str] = (),
) -> DataFrame:
    """Clean, anonymise, label, add calendar features, scale and encode.

    Encoding replaces a text column by its code; ids and labels are never scaled. The
    cleaned rows are written once when fitted steps follow, as those read them again
    and removing duplicates is the only full shuffle here.
    """
    out = clean_rows(df)
    out = anonymize(out, address_columns)
    if code in out.columns:
        out = status_label(out, code)
    out = calendar_features(out, time_column).drop(time_column)
    if encode or scale:
        out = materialize(out, "clean-rows")
    first = [c for c in scale if c not in encode]
    if first:
        out = standardize(out, first)
    for column in encode:
        out = label_encode(out, column, output=column)
    last = [c for c in scale if c in encode]
    return standardize(out, last) if last else out
