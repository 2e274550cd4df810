"""Splits, samples and re-stamping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.functions.columns import hash_bucket
from trafficlens.operators.ordering import dense_ids
from trafficlens.session import broadcast_if_small, materialize

SEED = 42  # fixed value
TEST_PERCENT = 20  # fixed value


def hash_split(df: DataFrame, key: str, test_percent: int = TEST_PERCENT, seed: int = SEED) -> DataFrame:
    """Mark each row 'train' or 'test' by a hash of its key: no shuffle, same at any partitioning."""
    bucket = hash_bucket(F.col(key), seed)
    return df.withColumn("split", F.when(bucket < 100 - test_percent, "train").otherwise("test"))


def split_frames(df: DataFrame, key: str, test_percent: int = TEST_PERCENT, seed: int = SEED):
    marked = hash_split(df, key, test_percent, seed)
    return (
        marked.filter(F.col("split") == "train").drop("split"),
        marked.filter(F.col("split") == "test").drop("split"),
    )


def split_balance(df: DataFrame, key: str, label: str, test_percent: int = TEST_PERCENT, seed: int = SEED):
    """Rows per class and split of a hash split, to check it is balanced."""
    return hash_split(df, key, test_percent, seed).groupBy(label, "split").agg(F.count("*").alias("row_count"))


def stratified_split(
    df: DataFrame, key: str, label: str, test_percent: int = TEST_PERCENT, seed: int = SEED, cell_digits: int = 4
) -> DataFrame:
    """Exact stratified split: per class, the ``round(n * share)`` rows with the smallest hash are 'test'.

    The last test row of each class is found first. A class of any size is spread over
    hash cells (the leading hex digits), of which only counts leave the tasks; rows are
    ranked only in the one cell that holds the last test row. Marking the rows is then a comparison
    with one boundary per class, without a shuffle.
    """
    text = F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))
    order = F.md5(text)
    keyed = df.select(
        F.col(label).alias("_class"), F.col(key).alias("_key"), order.alias("_order")
    ).withColumn("_cell", F.substring("_order", 1, cell_digits))
    per_cell = keyed.groupBy("_class", "_cell").agg(F.count("*").alias("_n"))
    in_class = Window.partitionBy("_class")
    before = in_class.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    bounds = per_cell.select(
        "_class",
        "_cell",
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_below"),
        F.floor(F.sum("_n").over(in_class) * F.lit(test_percent / 100.0) + 0.5).cast("long").alias("_want"),
    )
    # At most one cell per class; a class without test rows has none.
    last_cell = bounds.filter("_below < _want AND _want <= _below + _n").select(
        F.col("_class").alias("_of"), F.col("_cell").alias("_at"), (F.col("_want") - F.col("_below")).alias("_need")
    )
    last_cell = broadcast_if_small(materialize(last_cell, "split-cells"))
    same = F.col("_class").eqNullSafe(F.col("_of")) & (F.col("_cell") == F.col("_at"))
    rank = F.row_number().over(Window.partitionBy("_of", "_at").orderBy("_order", "_key"))
    last_row = (
        keyed.join(last_cell, same)
        .withColumn("_rank", rank)
        .filter("_rank = _need")
        .select("_of", F.col("_order").alias("_last_order"), F.col("_key").alias("_last_key"))
    )
    last_row = broadcast_if_small(materialize(last_row, "split-bounds"))
    placed = df.withColumn("_order", order).join(last_row, F.col(label).eqNullSafe(F.col("_of")), "left")
    tie = (F.col("_order") == F.col("_last_order")) & (F.col(key) <= F.col("_last_key"))
    is_test = (F.col("_order") < F.col("_last_order")) | tie
    split = F.when(is_test, "test").otherwise("train")
    return placed.withColumn("split", split).drop("_order", "_of", "_last_order", "_last_key")


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key: a per-task top-n, then a merge of those."""
    return df.orderBy(key).limit(n)


def restamp_hourly(df: DataFrame, time_column: str, tie_breaker: str, start: str) -> DataFrame:
    """Give rows, in time order, consecutive hourly times from ``start`` on.

    The time type is kept. Ranks come from :func:`dense_ids`, not from one global window.
    """
    kind = df.schema[time_column].dataType.simpleString()
    ranked = dense_ids(df, [time_column, tie_breaker], "_rank", start=0)
    stamped = F.timestamp_add("HOUR", F.col("_rank").cast("int"), F.lit(start).cast("timestamp")).cast(kind)
    return ranked.withColumn(time_column, stamped).drop("_rank")
