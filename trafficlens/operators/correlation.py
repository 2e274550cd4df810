"""Pearson correlation of all column pairs, using the rows where both are present."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.columns import clean_number, named
from trafficlens.operators.wide import feature_stats, packed_array

PAIRWISE_LIMIT = 3
FLAT = 1e-12  # deviation, in units of the mean or 1, up to which a column counts as constant


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per ordered column pair; NULL where a side is constant.

    A few columns take one built-in aggregate per pair. The number of pairs grows
    with the square of the columns, so more columns are packed and their cross
    products are summed as matrices, one per task.
    """
    names = list(columns)
    if len(names) > PAIRWISE_LIMIT:
        return _by_matrix(df, names)
    cells = [_cell(a, a, _pearson(a, a)) for a in names]
    for a, b in combinations(names, 2):
        value = _pearson(a, b)
        cells += [_cell(a, b, value), _cell(b, a, value)]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _cell(a: str, b: str, value: Column) -> Column:
    return F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), value.alias("correlation"))


def _pearson(a: str, b: str) -> Column:
    """NULL when either side is constant, where the built-in ``corr`` stops with a division error.

    Constant is a deviation that the mean's own rounding could cause; NaN and infinities are missing.
    """
    x, y = clean_number(named(a)), clean_number(named(b))
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)

    def varies(v: Column) -> Column:
        return F.stddev_pop(v) > FLAT * F.greatest(F.abs(F.avg(v)), F.lit(1.0))

    return F.when(varies(both_x) & varies(both_y), F.covar_pop(x, y) / (F.stddev_pop(both_x) * F.stddev_pop(both_y)))


# Per column i, over the rows where i and j are both present: their number, the sums and
# squared sums of either side, and the sum of products, each as an array over j.
_PARTS = ("n", "sx", "sy", "qx", "qy", "p")


def _by_matrix(df: DataFrame, names: list[str]) -> DataFrame:
    stats = feature_stats(df, names)
    width = len(names)
    mean = np.array(stats.mean)
    flat = np.array(stats.std) <= FLAT * np.maximum(np.abs(mean), 1.0)
    scale = np.where(flat, 1.0, stats.std)

    def cross_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, p = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            flat_values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            for part in np.array_split(flat_values.reshape(-1, width), max(1, len(batch) // 1024)):
                seen = ~np.isnan(part)
                x = np.where(seen & ~flat, (part - mean) / scale, 0.0)
                mask = seen.astype("float64")
                n += mask.T @ mask
                s += x.T @ mask
                q += (x * x).T @ mask
                p += x.T @ x
        kind = pa.list_(pa.float64())
        arrays = [pa.array(list(m), type=kind) for m in (n, s, s.T, q, q.T, p)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype="int32")), *arrays], names=["i", *_PARTS]
        )

    schema = "i int, " + ", ".join(f"{name} array<double>" for name in _PARTS)
    partial = df.select(packed_array(names).alias("x")).mapInArrow(cross_products, schema)
    sums = partial.groupBy("i").agg(
        *[vector_to_array(Summarizer.sum(array_to_vector(F.col(name)))).alias(name) for name in _PARTS]
    )
    cells = sums.select("i", F.posexplode(F.arrays_zip(*_PARTS)).alias("j", "c"))

    def mean_of(name: str) -> Column:
        return F.try_divide(f"c.{name}", "c.n")

    cov = mean_of("p") - mean_of("sx") * mean_of("sy")
    var_x = mean_of("qx") - mean_of("sx") * mean_of("sx")
    var_y = mean_of("qy") - mean_of("sy") * mean_of("sy")
    # The values are in units of each column's own deviation, so the pair's constant test is rescaled.
    limits = F.expr("array(" + ", ".join(f"{(FLAT * max(abs(m), 1.0) / w) ** 2!r}D" for m, w in zip(mean.tolist(), scale.tolist())) + ")")
    varied = (var_x > limits[F.col("i")]) & (var_y > limits[F.col("j")])
    value = F.when(varied, cov / F.sqrt(var_x * var_y))
    label = F.expr("array(" + ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names) + ")")
    return cells.select(
        label[F.col("i")].alias("column_a"), label[F.col("j")].alias("column_b"), value.alias("correlation")
    )
