"""Mean imputation and scaling for feature tables of any width.

One aggregate expression per column makes planning and code generation the
bottleneck for hundreds of columns, so beyond a limit the columns are packed into
one vector and summarised together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.columns import MAX_ABS_VALUE, clean_number, named

NARROW_LIMIT = 32


@dataclass(frozen=True)
class FeatureStats:
    """Per-feature mean and population deviation, and the row count; one entry per column."""

    columns: list[str]
    mean: list[float]
    std: list[float]
    rows: int = 0


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def number_sql(column: str) -> str:
    """The storable number in a column, else NULL; the text form of :func:`clean_number`."""
    number = f"CAST({_quoted(column)} AS double)"
    return f"CASE WHEN abs({number}) <= {MAX_ABS_VALUE!r}D THEN {number} END"


def _constants(values: Sequence[float]) -> Column:
    """Array literal. SQL text, as building hundreds of literals one by one takes seconds."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def packed_array(columns: Sequence[str]) -> Column:
    """Columns as one array<double> with NULL for missing entries, NaN and infinities."""
    array = F.expr("CAST(array(" + ", ".join(map(_quoted, columns)) + ") AS array<double>)")
    return F.transform(array, clean_number)


def filled_array(columns: Sequence[str], mean: Sequence[float]) -> Column:
    """Columns as one array<double>, missing entries filled with the mean.

    Few columns stay in generated code; for many, one loop over the array is cheaper
    than one generated expression per column.
    """
    if len(columns) > NARROW_LIMIT:
        return F.zip_with(packed_array(columns), _constants(mean), lambda v, m: F.coalesce(v, m))
    entries = [
        f"coalesce({number_sql(c)}, {float(m)!r}D)"
        for c, m in zip(columns, mean)
    ]
    return F.expr("array(" + ", ".join(entries) + ")")


def scaled_array(stats: FeatureStats) -> Column:
    """Columns as one array, imputed and standardised; a constant feature is divided by 1."""
    width = [s if s > 0 else 1.0 for s in stats.std]
    if len(stats.columns) > NARROW_LIMIT:
        filled = filled_array(stats.columns, stats.mean)
        centred = F.zip_with(filled, _constants(stats.mean), lambda v, m: v - m)
        return F.zip_with(centred, _constants(width), lambda v, w: v / w)
    entries = [
        f"(coalesce({number_sql(c)}, {float(m)!r}D) - {float(m)!r}D)"
        f" / {float(w)!r}D"
        for c, m, w in zip(stats.columns, stats.mean, width)
    ]
    return F.expr("array(" + ", ".join(entries) + ")")


def scaled_vector(stats: FeatureStats) -> Column:
    return array_to_vector(scaled_array(stats))


def feature_stats(df: DataFrame, columns: Sequence[str]) -> FeatureStats:
    """Mean without missing values, and population deviation after mean imputation."""
    names = list(columns)
    if len(names) <= NARROW_LIMIT:
        return _narrow_stats(df, names)
    packed = df.select(packed_array(names).alias("x"))
    value = array_to_vector(F.transform("x", lambda v: F.coalesce(v, F.lit(0.0))))
    seen = array_to_vector(F.transform("x", lambda v: F.when(v.isNull(), 0.0).otherwise(1.0)))
    first = packed.agg(
        Summarizer.sum(value).alias("value"), Summarizer.sum(seen).alias("seen"), F.count("*").alias("rows")
    ).first()
    if not first["rows"]:
        return FeatureStats(names, [0.0] * len(names), [0.0] * len(names))
    mean = [float(v) / float(k) if k else 0.0 for v, k in zip(first["value"], first["seen"])]
    filled = array_to_vector(filled_array(names, mean))
    second = df.agg(Summarizer.variance(filled).alias("var")).first()
    # Summarizer gives the sample variance; the population one is smaller by (n-1)/n.
    shrink = (first["rows"] - 1) / first["rows"]
    return FeatureStats(names, mean, [float(v * shrink) ** 0.5 for v in second["var"]], first["rows"])


def _narrow_stats(df: DataFrame, names: list[str]) -> FeatureStats:
    aggregates = [F.count("*").alias("rows")]
    for i, c in enumerate(names):
        v = clean_number(named(c))
        aggregates += [
            F.avg(v).alias(f"mean{i}"),
            F.count(v).alias(f"seen{i}"),
            F.var_pop(v).alias(f"var{i}"),
        ]
    row = df.agg(*aggregates).first()
    mean, std = [], []
    for i in range(len(names)):
        mean.append(float(row[f"mean{i}"] or 0.0))
        # Imputed rows sit on the mean, so they add no deviation but do count.
        squares = (row[f"var{i}"] or 0.0) * row[f"seen{i}"]
        std.append((squares / row["rows"]) ** 0.5 if row["rows"] else 0.0)
    return FeatureStats(names, mean, std, row["rows"])
