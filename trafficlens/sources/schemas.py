"""Table layouts, column naming rules and schema inference."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions.columns import named

# Table layouts.
LAYOUTS = {
    "sessions": (
        "id long, srcIP string, dstIP string, srcMAC string, dstMAC string, srcPort int, dstPort int, "
        "TSesStart timestamp, TSesEnd timestamp, SessDuration double, "
        "PktPerSesIn double, PktPerSesOut double, BPerSesIn double, BPerSesOut double, "
        "BPerSecIn double, BPerSecOut double, PktPerSIn double, PktPerSOut double, "
        "CntResendPktsIn double, CntResendPktsOut double, "
        "label int, label_2 string, label_poly string, label_poly_o string"
    ),
    "packets": "source_ip string, dest_ip string, timestamp timestamp, packet_size long",
    "http_log": (
        "log_time timestamp, source_ip string, dest_ip string, request_method string, "
        "response_code int, bytes_sent long, packet_size long"
    ),
    "flows_labelled": (
        "timestamp timestamp, src_ip string, dst_ip string, source_port int, destination_port int, "
        "protocol string, packet_size long, duration double, label string"
    ),
    "predictions": (
        "session_id long, model_type string, prediction int, anomaly_score double, "
        "confidence_score double, traffic_type string, is_anomaly int, risk_level string, "
        "log_time timestamp"
    ),
    "anomaly_results": "original_id long, anomaly_score double, is_anomaly int",
    "supervised_predictions": "original_id long, predicted_label int, confidence_score double",
    "summary_stats": (
        "total_records long, anomaly_count long, normal_count long, supervised_predictions long, "
        "anomaly_percentage decimal(5,2), avg_anomaly_score double, min_anomaly_score double, "
        "max_anomaly_score double, model_accuracy decimal(5,2), processing_date date"
    ),
    "prediction_anomaly": (
        "source_ip string, timestamp timestamp, anomaly_flag int, diff_seconds double"
    ),
    "performance_history": (
        "timestamp timestamp, accuracy double, precision double, recall double, f1_score double, "
        "sample_size long"
    ),
    "pipeline_runs": (
        "run_id string, timestamp timestamp, mode string, start_time timestamp, end_time timestamp, "
        "execution_time_seconds double, success boolean, steps_completed array<string>, "
        "error_message string, metrics map<string,double>, data_stats map<string,string>"
    ),
}

REQUIRED_TABLES = ("sessions", "anomaly_results", "supervised_predictions", "summary_stats", "predictions")


def layout(name: str) -> T.StructType:
    return T.StructType.fromDDL(LAYOUTS[name])


def standard_name(name: str) -> str:
    """Trimmed, lower-cased, every other character than a-z and 0-9 becomes an underscore."""
    return re.sub(r"[^a-z0-9]", "_", name.strip().lower())


def table_safe_name(name: str) -> str:
    """Angle brackets, blanks and hyphens become underscores; case is kept."""
    return re.sub(r"[<> \-]", "_", name)


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``rule``; names that would collide are an error."""
    renamed = [rule(c) for c in df.columns]
    twice = sorted(n for n, k in Counter(n.lower() for n in renamed).items() if k > 1)
    if twice:
        raise ValueError(f"column names collide after renaming: {', '.join(twice)}")
    return df.toDF(*renamed)


def storage_type(kind: T.DataType) -> T.DataType:
    """Type a column is stored as: wide integers and doubles, 0/1 flags, timestamps, text."""
    if isinstance(kind, T.BooleanType):
        return T.IntegerType()
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return T.DoubleType()
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return T.TimestampType()
    return T.StringType()


def storage_schema(schema: T.StructType) -> T.StructType:
    """Schema of the stored table for an inferred schema."""
    return T.StructType([T.StructField(f.name, storage_type(f.dataType), f.nullable) for f in schema])


def to_storage(df: DataFrame) -> DataFrame:
    """Cast every column to its storage type."""
    return df.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in storage_schema(df.schema)])


#: What a text can be read as, from narrow to wide; a column takes the widest of its values.
_KINDS = ("flag", "whole", "number", "text")


WHOLE = r"^-?(0|[1-9][0-9]*)$"
NUMBER = r"^(-?(0|[1-9][0-9]*)(\.[0-9]*([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)|-?\.[0-9]+([eE][+-]?[0-9]+)?|NaN|-?(Infinity|inf))$"


def infer_csv_schema(spark: SparkSession, path: str, sep: str = ";") -> T.StructType:
    """Whole-number, number, flag or text per column, from all rows of all files.

    Every value is marked by what it can be read as, the marks of a row are one vector, and
    one pass takes the maximum over the vectors, so hundreds of columns cost one aggregate.
    A column without any value is text. Whole numbers widen to numbers, all else to text. Only plain
    numbers count as such: codes with leading zeros or a plus sign ('007', '+49'), numbers with a type
    letter ('1D') and whole numbers beyond 64 bits stay text, as a number would not keep them.
    """
    rows = spark.read.option("sep", sep).option("header", True).csv(path)

    def marks(value):
        flag = F.lower(value).isin("true", "false")
        whole = value.rlike(WHOLE) & value.try_cast("long").isNotNull()
        number = value.rlike(NUMBER)
        place = F.when(flag, 0).when(whole, 1).when(number, 2).otherwise(3)
        return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(value.isNotNull() & (place == i), 1.0).otherwise(0.0))

    packed = rows.select(F.array(*[named(c) for c in rows.columns]).alias("x"))
    seen = packed.agg(Summarizer.max(array_to_vector(F.flatten(F.transform("x", marks)))).alias("seen")).first()["seen"]
    fields = []
    for i, name in enumerate(rows.columns):
        here = set() if seen is None else {k for k, m in zip(_KINDS, seen[4 * i : 4 * i + 4]) if m}
        if here == {"flag"}:
            kind: T.DataType = T.BooleanType()
        elif here == {"whole"}:
            kind = T.LongType()
        elif here and here <= {"whole", "number"}:
            kind = T.DoubleType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(name, kind, True))
    return T.StructType(fields)


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail before a plan is built when a needed column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def missing_tables(spark: SparkSession, required: Iterable[str] = REQUIRED_TABLES, database: str | None = None):
    """Required table names that the catalog does not list."""
    present = {t.name.lower() for t in spark.catalog.listTables(database)}
    return sorted(n for n in required if n.lower() not in present)
