"""Scans: wide and plain CSV, Parquet, database tables, incremental reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions.columns import epoch_to_timestamp, named

BAD_RECORD = "_bad_record"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with header and a fixed schema. Rows of another width or type carry their raw text
    in ``_bad_record``; :func:`split_bad_records` separates them."""
    with_bad = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType(), True)])
    return (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        # With pruning, a row's width is checked only for the columns a query happens to use.
        .option("columnPruning", False)
        .schema(with_bad)
        .csv(path)
    )


def read_wide_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    epoch_columns: Sequence[str] = ("TSesStart", "TSesEnd"),
) -> DataFrame:
    """Semicolon CSV whose start and end times are epoch seconds."""
    raw = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in epoch_columns else f.dataType, True) for f in schema]
    )
    df = read_csv(spark, path, raw, sep=";")
    present = {c: epoch_to_timestamp(named(c)) for c in epoch_columns if c in df.columns}
    return df.withColumns(present)


def split_bad_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, rows that do not with their raw text in ``_bad_record``)."""
    is_bad = F.col(BAD_RECORD).isNotNull()
    # Types are checked only for columns that a plan uses. A test that always holds but looks at
    # every column makes counting, writing and filtering agree on which rows are bad.
    reads_data = F.pmod(F.xxhash64(*[named(c) for c in df.columns if c != BAD_RECORD]), F.lit(2)) < 2
    return df.filter(~is_bad & reads_data).drop(BAD_RECORD), df.filter(is_bad & reads_data)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str],
) -> DataFrame:
    """Parallel table read split on a numeric key. Connection options come from the caller."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties),
    )


def rows_after(df: DataFrame, time_column: str, mark: datetime | str | Column) -> DataFrame:
    """Rows newer than the high-water mark; a literal mark is pushed into the scan."""
    kind = df.schema[time_column].dataType
    bound = mark if isinstance(mark, Column) else F.lit(mark)
    return df.filter(F.col(time_column) > bound.cast(kind))


def high_water_mark(df: DataFrame, time_column: str, fallback: datetime | str) -> Column:
    """Largest processed time, or the fallback when nothing was processed, as a scalar subquery."""
    kind = df.schema[time_column].dataType
    return df.agg(F.coalesce(F.max(time_column), F.lit(fallback).cast(kind)).alias("mark")).scalar()


def rows_since(df: DataFrame, mark: DataFrame, time_column: str, key: str) -> DataFrame:
    """Rows not loaded before, given a composite mark: the newest loaded time and the keys loaded at it.

    Rows of the mark's own time that arrive later are new, unless their key is in the mark. An empty mark takes
    all rows; rows without a time are never new. Make the mark with :func:`composite_mark`.
    """
    newest = mark.agg(F.max(time_column)).scalar()
    later = df.filter(F.col(time_column).isNotNull() & F.coalesce(F.col(time_column) >= newest, F.lit(True)))
    return later.join(mark.select(time_column, key), [time_column, key], "left_anti").select(*df.columns)


def composite_mark(loaded: DataFrame, time_column: str, key: str, before: DataFrame | None = None) -> DataFrame:
    """(time, key) of the loaded rows that have the newest time, those of the former mark among them.

    Store it with the run; a load without rows keeps the former mark.
    """
    rows = loaded.select(time_column, key)
    if before is not None:
        rows = rows.unionByName(before.select(time_column, key))
    return rows.filter(F.col(time_column) == rows.agg(F.max(time_column)).scalar()).distinct()


def set_aside(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Good rows, and the number of bad ones, whose raw texts are appended under ``path``."""
    good, bad = split_bad_records(df)
    bad.select(BAD_RECORD).write.mode("append").parquet(path)
    return good, bad.count()


def load_layouts(
    spark: SparkSession, sources: Mapping[str, tuple[str, T.StructType, Sequence[str]]], quarantine: str
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Load several CSV sources, each to its own column list: name -> (path, schema, columns).

    Returns the frames and the number of rejected rows by name; these are kept under ``quarantine``.
    """
    frames, rejected = {}, {}
    for name, (path, schema, columns) in sources.items():
        good, rejected[name] = set_aside(read_csv(spark, path, schema), f"{quarantine}/{name}")
        frames[name] = good.select(*columns)
    return frames, rejected


def conform(df: DataFrame, mapping: Mapping[str, str | Column], schema: T.StructType) -> DataFrame:
    """Project to a target layout: target name -> source column or constant expression."""
    missing = [f.name for f in schema if f.name not in mapping]
    if missing:
        raise ValueError(f"no mapping for: {', '.join(missing)}")

    def value(target: T.StructField) -> Column:
        given = mapping[target.name]
        source = named(given) if isinstance(given, str) else given
        return source.cast(target.dataType).alias(target.name)

    return df.select(*[value(f) for f in schema])
