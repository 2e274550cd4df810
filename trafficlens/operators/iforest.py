"""Isolation forest: hash sampling, distributed tree growth, broadcast scoring.

Only about trees x sample rows are shuffled to grow the trees, whatever the size
of the input; scoring is one pass without a shuffle. Neither depends on how the
input is partitioned.

Everything random comes from MD5 sums: a row's tickets from its id, a node's feature and cut from
tree and node. So any engine that has MD5 can grow the same forest from the same table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx
from trafficlens.operators.ordering import exact_quantiles
from trafficlens.operators.wide import feature_stats, filled_array
from trafficlens.session import materialize, spread

# Fixed values.
TREES = 100
SAMPLE_SIZE = 256
CONTAMINATION = 0.1
AUTO_OFFSET = -0.5
SEED = 42
GROW_TASKS = 25
#: Digits of an MD5 sum that make a random number, and how many such numbers there are.
_DIGITS = 13
_HASH_SPAN = 1 << (4 * _DIGITS)
#: Path lengths are whole multiples of this, so that their sums are exact.
PATH_UNIT = 2.0**-32

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"


@dataclass(frozen=True)
class IsolationForest:
    """A fitted forest. ``nodes`` has at most 2 x trees x sample rows, a size fixed by parameters."""

    features: list[str]
    mean: list[float]
    sample_size: int
    offset: float
    rows: int
    nodes: pd.DataFrame = field(repr=False)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        params = [
            (self.features, [float(m) for m in self.mean], self.sample_size, float(self.offset), self.rows)
        ]
        spark.createDataFrame(
            params, "features array<string>, mean array<double>, sample_size int, offset double, rows long"
        ).write.mode("overwrite").parquet(f"{path}/params")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        p = spark.read.parquet(f"{path}/params").first()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        return IsolationForest(list(p["features"]), list(p["mean"]), p["sample_size"], p["offset"], p["rows"], nodes)


def expected_path(size: np.ndarray | float):
    """Mean path length of an unsuccessful search among ``size`` points."""
    n = np.asarray(size, dtype="float64")
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _lot(*parts: Column) -> Column:
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("long")


def node_chance(seed: int, tree: int, node: int, what: str) -> float:
    """Random number from 0 to below 1 of a node, numbered as in a heap."""
    return int(hashlib.md5(f"{seed}|{tree}|{node}|{what}".encode()).hexdigest()[:_DIGITS], 16) / _HASH_SPAN


def _draw(df: DataFrame, id_column: str, rows: int, sample: int, trees: int, seed: int) -> DataFrame:
    """(tree, id, x): each tree gets the ``sample`` rows with the smallest hash among its draw.

    One cheap hash per row first keeps the rows that can be in any tree, so the
    per-tree hashes are computed for a few tens of thousands of rows only.
    """
    share = min(1.0, (sample + 6.0 * math.sqrt(sample)) / rows)
    any_tree = min(1.0, share * trees)
    key = F.col(id_column)
    lot = _lot(key, F.lit(seed))
    candidates = df.filter(lot < int(any_tree * _HASH_SPAN)) if any_tree < 1.0 else df
    per_tree = candidates.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    ticket = _lot(key, F.col("tree"), F.lit(seed))
    drawn = per_tree.withColumn("ticket", ticket)
    inner = share / any_tree
    if inner < 1.0:
        drawn = drawn.filter(F.col("ticket") < int(inner * _HASH_SPAN))
    order = Window.partitionBy("tree").orderBy("ticket", key)
    # A fixed number of tasks: the drawn rows are few, but growing trees is slow work
    # that adaptive execution would otherwise put into one task.
    spread_trees = drawn.repartition(min(trees, GROW_TASKS), "tree")
    return (
        spread_trees.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= sample)
        .select("tree", "place", "x")
    )


def _grow(points: np.ndarray, depth_limit: int, seed: int, tree: int) -> list[tuple]:
    """One random tree as node rows; leaves carry the full expected path length."""
    nodes: list[list] = [[-1, np.inf, 0, 0, 0.0]]
    todo = [(0, 0, np.arange(len(points)), 0)]
    while todo:
        slot, place, members, depth = todo.pop()
        part = points[members]
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= depth_limit or not len(open_features):
            path = math.floor((depth + float(expected_path(len(members)))) / PATH_UNIT + 0.5) * PATH_UNIT
            nodes[slot] = [-1, np.inf, slot, slot, path]
            continue
        f = int(open_features[int(node_chance(seed, tree, place, "feature") * len(open_features))])
        cut = float(low[f] + node_chance(seed, tree, place, "cut") * (high[f] - low[f]))
        if cut <= low[f]:
            cut = float(high[f])
        below = part[:, f] < cut
        left, right = len(nodes), len(nodes) + 1
        nodes[slot] = [f, cut, left, right, 0.0]
        nodes += [[-1, np.inf, left, left, 0.0], [-1, np.inf, right, right, 0.0]]
        todo += [(left, 2 * place + 1, members[below], depth + 1), (right, 2 * place + 2, members[~below], depth + 1)]
    return [(i, *n) for i, n in enumerate(nodes)]


def fit_forest(
    df: DataFrame,
    id_column: str,
    features: Sequence[str],
    trees: int = TREES,
    sample_size: int = SAMPLE_SIZE,
    seed: int = SEED,
) -> IsolationForest:
    """Grow the trees. ``id_column`` must be unique. The offset is the 'auto' one until set."""
    stats = feature_stats(df, features)
    rows = stats.rows
    if not rows:
        raise ValueError("cannot fit a forest on an empty table")
    sample = min(sample_size, rows)
    depth_limit = math.ceil(math.log2(max(sample, 2)))
    packed = df.select(id_column, filled_array(features, stats.mean).alias("x"))

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        points = np.vstack(pdf.sort_values("place")["x"].to_numpy())
        out = pd.DataFrame(
            _grow(points, depth_limit, seed, tree), columns=["node", "feature", "threshold", "left", "right", "path"]
        )
        out.insert(0, "tree", tree)
        return out

    # Every group has at most `sample` rows.
    grown = _draw(packed, id_column, rows, sample, trees, seed).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    nodes = grown.toPandas().sort_values(["tree", "node"], ignore_index=True)
    return IsolationForest(list(features), list(stats.mean), sample, AUTO_OFFSET, rows, nodes)


def _scorer(model: IsolationForest, spark: SparkSession) -> Column:
    """Arrow function over the packed features giving the raw score in [-1, 0]."""
    nodes = model.nodes
    sizes = nodes.groupby("tree", sort=True).size().to_numpy()
    # Indices in the machine's own width: other integer types are converted at every lookup.
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.intp)
    base = np.repeat(starts, sizes)
    child = np.empty(2 * len(nodes), dtype=np.intp)
    child[0::2] = nodes["left"].to_numpy() + base
    child[1::2] = nodes["right"].to_numpy() + base
    tables = (
        starts,
        np.maximum(nodes["feature"].to_numpy(), 0).astype(np.intp),
        nodes["threshold"].to_numpy(dtype="float64"),
        child,
        nodes["path"].to_numpy(dtype="float64"),
    )
    shared = spark.sparkContext.broadcast(tables)
    levels = math.ceil(math.log2(max(model.sample_size, 2)))
    norm = float(expected_path(model.sample_size)) or 1.0
    width = len(model.features)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        roots, feature, threshold, children, path = shared.value
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False)
            count = len(batch)
            out = np.empty(count)
            for a in range(0, count, 2048):  # keeps the rows x trees matrix inside the cache
                b = min(a + 2048, count)
                first = (np.arange(a, b, dtype=np.intp) * width)[:, None]
                at = np.broadcast_to(roots, (b - a, len(roots))).copy()
                for _ in range(levels):
                    cell = feature.take(at)
                    cell += first
                    right = x.take(cell) >= threshold.take(at)
                    at += at
                    at += right
                    at = children.take(at)
                out[a:b] = -np.exp2(-path.take(at).mean(axis=1) / norm)
            yield pa.array(out)

    return score(filled_array(model.features, model.mean))


def raw_scores(df: DataFrame, model: IsolationForest, output: str = "raw_score") -> DataFrame:
    """Add the raw score; lower is more isolated."""
    return df.withColumn(output, _scorer(model, df.sparkSession))


def _decide(df: DataFrame, offset: float) -> DataFrame:
    value = F.col("raw_score") - F.lit(offset)
    flag = fx.score_flag(value)
    return df.withColumns(
        {"anomaly_score": value, "prediction": flag, "traffic_type": fx.traffic_label(flag)}
    ).drop("raw_score")


def score_forest(df: DataFrame, model: IsolationForest) -> DataFrame:
    """Decision value (below 0 is anomalous), 0/1 prediction and label with a fitted model."""
    return _decide(raw_scores(df, model), model.offset)


def detect(
    df: DataFrame,
    id_column: str,
    features: Sequence[str],
    contamination: float | str = CONTAMINATION,
    trees: int = TREES,
    sample_size: int = SAMPLE_SIZE,
    seed: int = SEED,
) -> tuple[DataFrame, IsolationForest]:
    """Fit, set the threshold at the contamination quantile and score.

    Only the scores are written for the threshold, never the columns of the input; the
    result is scored as it is read. When nothing falls below the threshold, nothing is reported.
    """
    model = fit_forest(df, id_column, features, trees, sample_size, seed)
    evenly = spread(df, model.rows)
    if contamination == "auto":
        return score_forest(evenly, model), model
    scores = materialize(raw_scores(evenly, model).select("raw_score"), "forest-scores")
    offset = exact_quantiles(scores, "raw_score", [float(contamination)])[0]
    model = replace(model, offset=AUTO_OFFSET if offset is None else float(offset))
    return score_forest(evenly, model), model
