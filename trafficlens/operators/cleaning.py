"""Null handling, value sanitising, imputation, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions.columns import clean_number, named

# Fill defaults by kind of column.
NUMBER_FILL = 0
TEXT_FILL = "unknown"
TIME_FILL = "1970-01-01 00:00:00"


def sanitize_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN, infinities and oversized values of double columns become NULL."""
    return df.withColumns({c: clean_number(named(c)) for c in columns})


def flags_to_int(df: DataFrame) -> DataFrame:
    """Boolean columns as 0/1."""
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: named(c).cast("int") for c in flags})


def fill_by_type(df: DataFrame, fill_times: bool = False) -> DataFrame:
    """NULL to 0 / 'unknown' by column type. Times stay NULL unless asked for."""
    filled: dict[str, Column] = {}
    for f in df.schema:
        c = named(f.name)
        if isinstance(f.dataType, T.NumericType):
            filled[f.name] = F.coalesce(c, F.lit(NUMBER_FILL).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            filled[f.name] = F.coalesce(c, F.lit(TEXT_FILL))
        elif fill_times and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            filled[f.name] = F.coalesce(c, F.lit(TIME_FILL).cast(f.dataType))
    return df.withColumns(filled)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULL, NaN and infinities with the column mean over the whole table.

    The means are one scalar subquery (a single row), evaluated once per plan.
    For more than about 100 columns use :mod:`trafficlens.operators.wide`.
    """
    number = {c: clean_number(named(c)) for c in columns}
    means = df.agg(F.struct(*[F.avg(v).alias(c) for c, v in number.items()]).alias("means")).scalar()
    return df.withColumns({c: F.coalesce(v, means.getField(c)) for c, v in number.items()})


def column_mode(df: DataFrame, column: str) -> Column:
    """Most frequent value, the smallest on ties, NULL if there is none; a scalar subquery.

    Counting combines map-side, and the winner is a two-field maximum over the
    distinct values, so neither a frequent value nor many values meet in one task.
    """
    counts = df.filter(named(column).isNotNull()).groupBy(named(column).alias("value")).agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return counts.agg(first.getField("value").alias("mode")).scalar()


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULL with the column mode, or 'unknown' when every value is missing."""
    return df.withColumns(
        {c: F.coalesce(named(c), column_mode(df, c), F.lit(TEXT_FILL)) for c in columns}
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows holding any NULL or NaN."""
    return df.dropna("any")


def clean_rows(df: DataFrame) -> DataFrame:
    """Distinct rows without missing values; rows are filtered before they are shuffled."""
    return drop_incomplete(df).dropDuplicates()


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its number of missing values, from a single scan."""
    names = list(columns or df.columns)
    kinds = dict((f.name, f.dataType) for f in df.schema)

    def missing(name: str) -> Column:
        c = named(name)
        test = c.isNull()
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            test = test | F.isnan(c)
        return F.struct(F.lit(name).alias("column_name"), F.count_if(test).alias("null_count"))

    packed = df.agg(F.array(*[missing(n) for n in names]).alias("audit"))
    return packed.select(F.inline("audit"))
