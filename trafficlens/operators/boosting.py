"""Multi-class gradient boosting: one tree per class and round under the softmax loss.

The trees grow level by level. In one pass per level every task walks its rows to the open nodes of all
classes and sums gradients and hessians per (class, node, feature, bin); Spark adds these histograms,
running sums over the bins give the gain of every cut, and only the best cut of each node reaches the
driver. Gradients are whole multiples of 2**-24, so sums, cuts and trees are the same however the rows
are dealt out. All rows take part; nothing is sampled.

Rows are packed into blocks of bin numbers, written once; the margins are rewritten with them after
every ``WRITE_EVERY`` rounds, and trees since then are walked again. A missing number (NULL, NaN,
infinite) lies below all others. Rows without a label are left out. A feature's cuts are its distinct values where it has at most ``bins``, else quantiles of a
bounded sample (``EDGE_ROWS``); the histograms count all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlens.functions import columns as fx
from trafficlens.operators.wide import packed_array
from trafficlens.session import materialize, spread

# The defaults of the boosted classifier that is to be matched.
ROUNDS, DEPTH, STEP, SMOOTHING, LEAST_HESSIAN = 100, 6, 0.3, 1.0, 1.0
LEAST_GAIN = 1e-6
BINS = 64
UNIT = 1 << 24
#: Rows that a task works on at once. A stored block has fewer: a read batch may hold thousands of blocks.
BLOCK_ROWS = 8192
BLOCK_BYTES = 1 << 11
WRITE_EVERY = 8
MAX_CLASSES = 1_000
#: Rows, and bytes of them, from which cuts of many-valued features are taken.
EDGE_ROWS, EDGE_BYTES = 1 << 16, 32 << 20

BLOCKS = "n int, y binary, bins binary, margins binary"
CELLS = "class int, node int, feature int, bin int, g long, h long, n long"
NODES = "round int, class int, node int, feature int, cut int, threshold double, value double, gain double, hessian double, rows long"


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model. ``nodes`` has one row per node, numbered as in a heap; leaves have feature -1.

    ``losses`` holds the mean training loss before the first round and after each one.
    """

    features: list[str]
    classes: list[str]
    edges: list[list[float]]
    depth: int
    nodes: pd.DataFrame = field(repr=False)
    losses: list[float]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        params = [(self.features, self.classes, self.edges, self.depth, self.losses)]
        kinds = "features array<string>, classes array<string>, edges array<array<double>>, depth int, losses array<double>"
        spark.createDataFrame(params, kinds).write.mode("overwrite").parquet(f"{path}/params")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        p = spark.read.parquet(f"{path}/params").first()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("round", "class", "node").toPandas()
        return BoostedTrees(list(p["features"]), list(p["classes"]), [list(e) for e in p["edges"]], p["depth"], nodes, list(p["losses"]))


def feature_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Cuts per feature: the distinct values of few-valued features, else quantiles of a bounded sample.

    The sample is chosen by a hash of the row, so it does not depend on how rows are dealt out; equal
    rows are counted before they are collected.
    """
    names = [f"_{i}" for i in range(len(features))]
    numbers = df.select(*[fx.clean_number(fx.named(c)).alias(n) for n, c in zip(names, features)])
    about = numbers.agg(F.count("*").alias("rows"), *[F.approx_count_distinct(c).alias(c) for c in names]).first()
    few = [i for i, c in enumerate(names) if about[c] <= 2 * bins]
    known: dict[int, list[float]] = {i: [] for i in few}
    if few:
        pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(names[i]).alias("v")) for i in few])
        # At most about 2 * bins values per feature, by the count above.
        for r in numbers.select(F.explode(pairs).alias("p")).select("p.*").where("v IS NOT NULL").distinct().collect():
            known[r["i"]].append(r["v"])
    many = [i for i in range(len(features)) if i not in known or len(known[i]) > bins]
    sample = None
    if many:
        held = [names[i] for i in many]
        share = min(1.0, min(EDGE_ROWS, EDGE_BYTES // (8 * len(held))) / max(about["rows"], 1))
        chosen = numbers.select(*held).filter(F.pmod(F.xxhash64(*held), F.lit(1 << 30)) < int(share * (1 << 30)))
        sample = chosen.groupBy(*held).agg(F.count("*").alias("n")).toPandas()
    edges = []
    for i, c in enumerate(names):
        if i not in many:
            edges.append(sorted(v + 0.0 for v in known[i]))
            continue
        v = sample[c].to_numpy(dtype="float64")
        order = np.argsort(v[~np.isnan(v)], kind="stable")
        v, upto = v[~np.isnan(v)][order], np.cumsum(sample["n"].to_numpy()[~np.isnan(v)][order])
        ranks = [-(-k * int(upto[-1]) // bins) for k in range(1, bins + 1)] if len(v) else []
        edges.append(np.unique(v[np.searchsorted(upto, ranks)]).tolist() if ranks else [])
    return edges


def bin_numbers(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """0 for missing numbers, else 1 + the number of edges below; equal to an edge lies under it."""
    out = np.zeros(x.shape, np.uint16)
    for j, e in enumerate(edges):
        column = x[:, j]
        out[:, j] = np.where(np.isnan(column), 0, 1 + np.searchsorted(np.asarray(e, np.float64), column, side="left"))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(column), width)


def _packer(edges: list[list[float]], classes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = bin_numbers(_matrix(batch.column("x"), len(edges)), edges)
            y = batch.column("y").to_numpy().astype(np.int32)
            yield _blocks(y, bins, np.zeros((len(y), classes)))

    return pack


def _blocks(*arrays: np.ndarray) -> pa.RecordBatch:
    """The rows of some arrays as blocks of few bytes."""
    rows = len(arrays[0])
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(sum(a.nbytes for a in arrays) // max(rows, 1), 1)))
    ends = np.append(np.arange(0, rows, size), rows)
    columns = [pa.array(np.diff(ends), pa.int32())]
    for a in arrays:
        a = np.ascontiguousarray(a)
        offsets = (ends * (a.nbytes // max(rows, 1))).astype(np.int32)
        columns.append(pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(a)]))
    return pa.RecordBatch.from_arrays(columns, names=["n", "y", "bins", "margins"])


def _opened(batches: Iterator[pa.RecordBatch], width: int, classes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Up to ``BLOCK_ROWS`` rows at once, read in place: the blocks of a batch lie one behind the other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = []
        for column, kind, wide in zip(batch.columns[1:], (np.int32, np.uint16, np.float64), (1, width, classes)):
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            parts.append(np.frombuffer(column.buffers()[2], kind, (offsets[-1] - offsets[0]) // np.dtype(kind).itemsize, offsets[0]).reshape(-1, wide))
        for i in range(0, len(parts[0]), BLOCK_ROWS):
            y, bins, margins = (p[i : i + BLOCK_ROWS] for p in parts)
            yield y[:, 0], bins, margins


def reach(tree: tuple[np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after so many levels; rows stay where a node has no cut."""
    feature, cut, _ = tree
    at, rows = np.zeros(len(bins), np.intp), np.arange(len(bins))
    for _ in range(levels):
        f = feature[at]
        right = bins[rows, np.maximum(f, 0)] > cut[at]
        at = np.where(f < 0, at, 2 * at + 1 + right)
    return at


def with_trees(margins: np.ndarray, rounds: list[list[tuple]], bins: np.ndarray, depth: int) -> np.ndarray:
    out = margins.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            out[:, k] += tree[2][reach(tree, bins, depth)]
    return out


def chances(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def units(values: np.ndarray) -> np.ndarray:
    return np.floor(values * UNIT + 0.5).astype(np.int64)


def _histograms(rounds: list[list[tuple]], growing: list[tuple], level: int, depth: int, width: int, most: int):
    """Sums per (class, node, feature, bin); class -1 holds the loss and the number of rows."""
    classes, first, nodes = len(growing), (1 << level) - 1, 1 << level

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, classes, width, nodes * most), np.int64)
        loss = rows = 0
        for y, bins, margins in _opened(batches, width, classes):
            p = chances(with_trees(margins, rounds, bins, depth))
            rows += len(y)
            loss += int(units(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-16))).sum())
            for k in range(classes):
                at = reach(growing[k], bins, level) - first
                here = np.flatnonzero(at >= 0)
                g, h = units(p[here, k] - (y[here] == k)), units(np.maximum(2 * p[here, k] * (1 - p[here, k]), 1e-16))
                for j in range(width):
                    slot = at[here] * most + bins[here, j]
                    for i, w in enumerate((g, h, None)):
                        sums[i, k, j] += np.bincount(slot, w, nodes * most).astype(np.int64)
        k, j, slot = np.nonzero(sums[2])
        out = [k, slot // most + first, j, slot % most, *(sums[i][k, j, slot] for i in range(3))]
        out = [np.append(c, v) for c, v in zip(out, (-1, 0, 0, 0, loss, 0, rows))]
        kinds = [pa.int32()] * 4 + [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["class", "node", "feature", "bin", "g", "h", "n"])

    return count


def best_cuts(cells: DataFrame, smoothing: float, least: float) -> DataFrame:
    """Per (class, node): sums and the cut of greatest gain; equal gains by feature, then bin."""
    whole = Window.partitionBy("class", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = cells.select(
        "*", *[F.sum(c).over(upto).alias(f"{c}_left") for c in ("g", "h", "n")], *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("g", "h", "n")])

    def part(g: Column, h: Column) -> Column:
        g, h = g.cast("double") / UNIT, h.cast("double") / UNIT
        return g * g / (h + smoothing)

    g_right, h_right = F.col("g_all") - F.col("g_left"), F.col("h_all") - F.col("h_left")
    gain = part(F.col("g_left"), F.col("h_left")) + part(g_right, h_right) - part(F.col("g_all"), F.col("h_all"))
    allowed = (F.col("n_left") < F.col("n_all")) & (F.col("h_left") >= int(least * UNIT)) & (h_right >= int(least * UNIT)) & (gain > LEAST_GAIN)
    cut = F.struct(gain.alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"),
                   F.col("g_left").alias("g"), F.col("h_left").alias("h"), F.col("n_left").alias("n"))
    return sums.groupBy("class", "node").agg(
        F.max("g_all").alias("g"), F.max("h_all").alias("h"), F.max("n_all").alias("n"),
        F.max(F.when(allowed, cut)).alias("cut"))


def fit(
    df: DataFrame, features: Sequence[str], label: str = "label", rounds: int = ROUNDS, depth: int = DEPTH, step: float = STEP,
    smoothing: float = SMOOTHING, least_hessian: float = LEAST_HESSIAN, bins: int = BINS,
) -> BoostedTrees:
    """Boost ``rounds`` times; classes are the distinct labels as text, in order."""
    labelled = df.filter(fx.named(label).isNotNull())
    classes = sorted(r[0] for r in labelled.select(fx.named(label).cast("string")).distinct().limit(MAX_CLASSES + 1).collect())
    if not classes:
        raise ValueError("cannot boost without labelled rows")
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    edges = feature_edges(labelled, features, bins)
    width, most, k = len(features), max(len(e) for e in edges) + 2, len(classes)
    place = F.array_position(F.array(*map(F.lit, classes)), fx.named(label).cast("string")) - 1
    rows = labelled.select(place.cast("int").alias("y"), packed_array(features).alias("x"))
    blocks = materialize(spread(rows, rows.count()).mapInArrow(_packer(edges, k), BLOCKS), "boosting")
    size = (1 << (depth + 1)) - 1
    done: list[list[tuple]] = []
    nodes: list[tuple] = []
    losses: list[float] = []

    for r in range(rounds + 1):
        growing = [(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size)) for _ in classes]
        open_ = {(c, 0) for c in range(k)}
        for level in range(depth):
            counted = blocks.mapInArrow(_histograms(done, growing, level, depth, width, most), CELLS)
            cells = counted.groupBy("class", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
            # One row per class and open node.
            found = best_cuts(cells, smoothing, least_hessian).collect()
            if level == 0:
                told = next((x for x in found if x["class"] < 0))
                losses.append(told["g"] / UNIT / told["n"])
            if r == rounds:
                break
            following = set()
            for x in sorted((x for x in found if (x["class"], x["node"]) in open_), key=lambda x: (x["class"], x["node"])):
                following |= _settle(growing[x["class"]], nodes, r, x, edges, step, smoothing, level + 1 == depth)
            open_ = following
            if not open_:
                break
        if r == rounds:
            break
        done.append(growing)
        if len(done) == WRITE_EVERY:
            blocks = materialize(blocks.mapInArrow(_adder(done, depth, width, k), BLOCKS), "boosting")
            done = []
    table = pd.DataFrame(nodes, columns=[c.split()[0] for c in NODES.split(", ")]).sort_values(["round", "class", "node"], ignore_index=True)
    return BoostedTrees(list(features), classes, edges, depth, table, losses)


def _settle(tree: tuple, nodes: list[tuple], r: int, x, edges: list[list[float]], step: float, smoothing: float, last: bool) -> set[tuple[int, int]]:
    """Enter a node, and its children where they are leaves for certain; children still open are returned."""
    feature, cut, value = tree
    k, node = x["class"], x["node"]

    def leaf(at: int, g: int, h: int, n: int) -> None:
        value[at] = -step * (g / UNIT) / (h / UNIT + smoothing)
        nodes.append((r, k, at, -1, -1, math.inf, value[at], 0.0, h / UNIT, n))

    best = x["cut"]
    if best is None:
        leaf(node, x["g"], x["h"], x["n"])
        return set()
    j, b = -best["feature"], -best["bin"]
    feature[node], cut[node] = j, b
    threshold = edges[j][b - 1] if 0 < b <= len(edges[j]) else -math.inf
    nodes.append((r, k, node, j, b, threshold, 0.0, best["gain"], x["h"] / UNIT, x["n"]))
    left, right = 2 * node + 1, 2 * node + 2
    if not last:
        return {(k, left), (k, right)}
    leaf(left, best["g"], best["h"], best["n"])
    leaf(right, x["g"] - best["g"], x["h"] - best["h"], x["n"] - best["n"])
    return set()


def _adder(rounds: list[list[tuple]], depth: int, width: int, classes: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, bins, margins in _opened(batches, width, classes):
            yield _blocks(y, bins, with_trees(margins, rounds, bins, depth))

    return add


def probabilities(model: BoostedTrees, spark: SparkSession) -> Column:
    """Array of the classes' probabilities, in the order of ``model.classes``."""
    size, k = (1 << (model.depth + 1)) - 1, len(model.classes)
    rounds: list[list[tuple]] = []
    for r, c, node, j, b, value in model.nodes[["round", "class", "node", "feature", "cut", "value"]].itertuples(index=False):
        while len(rounds) <= r:
            rounds.append([(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size)) for _ in range(k)])
        tree = rounds[r][c]
        tree[0][node], tree[1][node], tree[2][node] = j, b, value
    shared = spark.sparkContext.broadcast((rounds, model.edges, model.depth, k))

    @F.arrow_udf("array<double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trees, edges, depth, width = shared.value
        for batch in batches:
            bins = bin_numbers(_matrix(batch, len(edges)), edges)
            p = chances(with_trees(np.zeros((len(batch), width)), trees, bins, depth))
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * width, pa.int32()), pa.array(p.ravel()))

    return score(packed_array(model.features))


def predict(df: DataFrame, model: BoostedTrees, prediction: str = "prediction", confidence: str = "confidence_score") -> DataFrame:
    """The most probable class (the first of equally probable ones), its probability and all probabilities."""
    scored = df.withColumn("probabilities", probabilities(model, df.sparkSession))
    top = F.array_max("probabilities")
    name = F.get(F.array(*map(F.lit, model.classes)), (F.array_position("probabilities", top) - 1).cast("int"))
    return scored.withColumns({prediction: name, confidence: top})


def importance(spark: SparkSession, model: BoostedTrees) -> DataFrame:
    """Share of the total gain, and number of cuts, of every feature."""
    cuts = model.nodes[model.nodes["feature"] >= 0].groupby("feature").agg(gain=("gain", "sum"), cuts=("gain", "size"))
    total = float(cuts["gain"].sum()) or 1.0
    rows = [(f, float(cuts["gain"].get(i, 0.0)) / total, int(cuts["cuts"].get(i, 0))) for i, f in enumerate(model.features)]
    return spark.createDataFrame(rows, "feature string, importance double, cuts long")


def losses(spark: SparkSession, model: BoostedTrees) -> DataFrame:
    """Mean training loss before the first round (round 0) and after every round."""
    return spark.createDataFrame(list(enumerate(model.losses)), "round int, loss double")
