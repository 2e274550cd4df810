"""Global order without a single-task sort: dense ids, running totals, exact quantiles.

A range repartition splits the rows evenly on the order columns (hot keys included,
when the order columns end in a unique one). The result is written once, so the
per-range totals and the rows agree, and only one small row per range is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.session import materialize

PART, POSITION = "_part", "_position"
_POSITION_BITS = 33  # fixed value: low bits of monotonically_increasing_id


def range_ordered(df: DataFrame, order: Sequence[str | Column], label: str = "ordered") -> DataFrame:
    """Rows with their range number and their position within the range."""
    keys = list(order)
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    table = materialize(rows.withColumn("_slot", F.monotonically_increasing_id()), label)
    return table.withColumns(
        {
            PART: F.shiftright("_slot", _POSITION_BITS),
            POSITION: F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1),
        }
    ).drop("_slot")


def _offsets(ordered: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """Per range, the totals of all earlier ranges. One row per range, so one task is enough."""
    per_part = ordered.groupBy(PART).agg(*[t.alias(name) for name, t in totals.items()])
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        PART, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals]
    )


def dense_ids(df: DataFrame, order: Sequence[str | Column], id_column: str = "id", start: int = 1) -> DataFrame:
    """Add consecutive ids in the given order. End the order with a unique column."""
    ordered = range_ordered(df, order, "dense-ids")
    offsets = _offsets(ordered, {"_before": F.count("*")})
    joined = ordered.join(F.broadcast(offsets), PART)
    return joined.withColumn(id_column, F.col("_before") + F.col(POSITION) + F.lit(start)).drop(
        PART, POSITION, "_before"
    )


def running_totals(df: DataFrame, order: Sequence[str | Column], sums: Mapping[str, str]) -> DataFrame:
    """Inclusive running sums in the given order: output name -> summed column."""
    ordered = range_ordered(df, order, "running-totals")
    offsets = _offsets(ordered, {f"_before_{name}": F.sum(column) for name, column in sums.items()})
    so_far = Window.partitionBy(PART).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, 0)
    joined = ordered.join(F.broadcast(offsets), PART)
    totals = {name: F.sum(column).over(so_far) + F.col(f"_before_{name}") for name, column in sums.items()}
    return joined.withColumns(totals).drop(PART, POSITION, *[f"_before_{name}" for name in sums])


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], bins: int = 1024
) -> list[float | None]:
    """Linearly interpolated quantiles, exact at any size.

    NULL and NaN are left out; infinities count as the least and greatest values. The first
    pass counts rows by sign and power of two. Each further pass counts at most
    ``2 * len(probabilities) * bins`` equal parts of the ranges that hold the wanted ranks and
    narrows to the parts, so no task ever holds the values. A range spans a factor of two, that
    is 2**52 doubles, so there are at most six such passes.
    """
    value = F.col(column).cast("double")
    data = df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counted = data.groupBy(_power("v").alias("slot")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    powers = sorted(counted.collect(), key=lambda r: r["slot"])  # one row per power of two
    total = sum(r["n"] for r in powers)
    if not total:
        return [None] * len(probabilities)
    positions = [p * (total - 1) for p in probabilities]
    wanted = {int(p) for p in positions} | {min(int(p) + 1, total - 1) for p in positions}
    # rank -> (low, high, number of rows below low)
    pending: dict[int, tuple[float, float, int]] = {}
    for rank in wanted:
        below = 0
        for row in powers:
            if rank < below + row["n"]:
                pending[rank] = (row["low"], row["high"], below)
                break
            below += row["n"]
    found: dict[int, float] = {}
    while pending:
        for rank, (low, high, _) in list(pending.items()):
            if low == high:
                found[rank] = low
                del pending[rank]
        intervals = sorted(set(pending.values()))
        if not intervals:
            break
        counted = _bin_counts(data, intervals, bins)
        for rank, interval in list(pending.items()):
            below = interval[2]
            for row in counted[intervals.index(interval)]:
                if rank < below + row["n"]:
                    pending[rank] = (row["low"], row["high"], below)
                    break
                below += row["n"]
    out: list[float | None] = []
    for p in positions:
        low = found[int(p)]
        high = found[min(int(p) + 1, total - 1)]
        part = p - int(p)
        # No arithmetic where it is not needed: infinities have no difference.
        out.append(low if low == high or not part else low * (1 - part) + high * part if abs(low) == float("inf") or abs(high) == float("inf") else low + part * (high - low))
    return out


def _power(column: str) -> Column:
    """Sign and power of two of a double as one number in the order of the values."""
    v = F.col(column)
    size = F.when(F.abs(v) == float("inf"), 3000).otherwise(F.floor(F.log2(F.abs(v))) + 1100)
    return F.when(v == 0, 0).otherwise(F.signum(v) * size).cast("int")


def _bin_counts(data: DataFrame, intervals: list[tuple], bins: int) -> list[list]:
    memberships = []
    for i, (low, high, _) in enumerate(intervals):
        # Halves, as the width of two large values may not be a number.
        share = (F.col("v") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
        slot = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
        inside = (F.col("v") >= low) & (F.col("v") <= high)
        memberships.append(F.when(inside, F.struct(F.lit(i).alias("i"), slot.alias("slot"))))
    touched = F.lit(False)
    for low, high, _ in intervals:
        touched = touched | ((F.col("v") >= low) & (F.col("v") <= high))
    # array_compact keeps only the intervals a value lies in, normally one.
    placed = data.filter(touched).select("v", F.explode(F.array_compact(F.array(*memberships))).alias("m"))
    rows = (
        placed.groupBy("m.i", "m.slot")
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()  # at most intervals * bins rows
    )
    grouped: list[list] = [[] for _ in intervals]
    for row in sorted(rows, key=lambda r: (r["i"], r["slot"])):
        grouped[row["i"]].append(row)
    return grouped
