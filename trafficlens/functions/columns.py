"""Column expressions. All are built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
HIGH_RISK_BELOW = -0.5
MEDIUM_RISK_BELOW = 0.0
MAX_ABS_VALUE = 1e38
MAX_EPOCH_SECONDS = 9223372036
ERROR_STATUS_FROM = 400


def named(column: str) -> Column:
    """A column by its exact name, which may hold dots, brackets or blanks."""
    return F.col("`" + column.replace("`", "``") + "`")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds (number or text) to timestamp, exact to the microsecond; anything unusable
    becomes NULL."""
    number = seconds.try_cast("decimal(20,6)")
    return F.when(F.abs(number) <= MAX_EPOCH_SECONDS, F.timestamp_seconds(number))


def text_to_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; invalid text becomes NULL."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def clean_number(value: Column) -> Column:
    """NaN, infinities and magnitudes above the storable range become NULL."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) <= MAX_ABS_VALUE), number)


def number_of(df: DataFrame, column: str) -> Column:
    """A column for statistics: NaN and infinities of a floating column are missing, other types stay."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return clean_number(named(column))
    return named(column)


def not_nan(value: Column) -> Column:
    """A double for comparisons: NaN, which Spark orders above all numbers, becomes NULL."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def anonymized(value: Column) -> Column:
    """SHA-256 hex of the text form; NULL stays NULL."""
    return F.sha2(value.cast("string"), 256)


def status_flag(code: Column) -> Column:
    """1 for response codes from 400 up, else 0; a missing code counts as normal."""
    return F.when(code >= ERROR_STATUS_FROM, 1).otherwise(0)


def text_flag(label: Column) -> Column:
    """'normal' to 0, 'anomaly' to 1, other text to NULL."""
    return F.when(label == "normal", 0).when(label == "anomaly", 1)


def score_flag(score: Column) -> Column:
    """1 when the decision value is below zero."""
    return F.when(score < 0, 1).otherwise(0)


def traffic_label(prediction: Column) -> Column:
    return F.when(prediction == 1, "anomaly").otherwise("normal")


def risk_band(score: Column) -> Column:
    """Risk text of a decision value; a missing score is low risk."""
    return (
        F.when(score < HIGH_RISK_BELOW, "High Risk")
        .when(score < MEDIUM_RISK_BELOW, "Medium Risk")
        .otherwise("Low Risk")
    )


def severity(score: Column) -> Column:
    """Larger is worse, the mirror of the decision value."""
    return -score


def point_colour(score: Column) -> Column:
    return F.when(score < 0, "red").otherwise("blue")


def binary_confidence(prediction: Column, probability: Column) -> Column:
    """Probability of the predicted class, given the probability of class 1."""
    return F.when(prediction == 1, probability).otherwise(1 - probability)


def hour_of(ts: Column, like: str) -> Column:
    """Start of the hour in the input's own timestamp type (``timestamp`` or ``timestamp_ntz``)."""
    return F.date_trunc("hour", ts).cast(like)


def seconds_between(start: Column, end: Column) -> Column:
    """Fractional seconds from start to end."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def per_second(amount: Column, duration: Column) -> Column:
    """Rate over a duration; a zero duration counts as one second."""
    return amount / F.when(duration == 0, 1.0).otherwise(duration.cast("double"))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """Share in percent; 0 when the whole is 0."""
    value = F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, 0 when the divisor is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Hour, day of week (Monday = 0), month and day of month."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "day": F.day(ts),
    }


def hour_packet_size(hour: Column) -> Column:
    """Packet size derived from the hour alone."""
    return F.lit(2000) + (hour * 17) % 2000


def hour_source_ip(hour: Column) -> Column:
    return F.concat(F.lit("192.168."), (hour % 256).cast("string"), F.lit(".1"))


def hour_dest_ip(hour: Column) -> Column:
    return F.concat(F.lit("192.168."), ((hour % 256 + 1) % 256).cast("string"), F.lit(".2"))


def hash_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from md5 of key and seed; independent of partitioning."""
    text = F.concat_ws("|", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets
