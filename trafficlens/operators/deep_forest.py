"""Random forest without a depth bound, grown in two phases.

While a node holds many rows, a whole level is split at once: every task walks its rows to the open
nodes of all trees and counts classes per (tree, node, feature, bin), Spark adds the counts, and only
the best cut of each node reaches the driver. Rows of nodes that hold at most ``small`` rows are
dealt out by (tree, node), and each such node is grown to the end in one task on exact values: until
its rows are of one class or equal in all features. Equal rows of a stretch are merged before they are dealt
out and once more where they meet, so copies are never many. Without a bootstrap the upper levels count cells,
rows of one class and equal bins with their number, whose number the bins bound whatever the size of the table.
A large node whose rows share the bins of all features goes to one task as well: its different rows
lie inside one bin of every feature.

A split looks at the square root of the number of features that vary, drawn per node. Bootstrap
weights are Poisson draws from a hash of tree and row key, so trees are the same however rows are
dealt out; rows with one key have one weight. Missing numbers lie below all others. Rows without a
label are left out. At most about ``fit_rows`` rows are used, chosen by a hash of the row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions import columns as fx
from trafficlens.operators.boosting import bin_numbers, feature_edges
from trafficlens.operators.sampling import SEED
from trafficlens.operators.wide import packed_array
from trafficlens.session import materialize, spread

# Fixed values.
TREES = 100
FIT_ROWS = 50_000
SMALL_ROWS = 4096
BINS = 64
MAX_CLASSES = 200
#: Trees are sent to the tasks in groups of about this many nodes; if one tree has more, rows go to the nodes instead.
GROUP_NODES = 200_000
#: Rows that a task merges into cells at once; nodes of at most so many rows are grown without arrays.
_MERGED, _FEW = 1 << 18, 16

NODES = "tree int, root int, node int, feature int, threshold double, left int, right int, counts array<double>"
#: Columns that travel with rows to be scored, and those of the nodes they meet.
_X, _VOTES, _ROOT = "_forest_x", "_forest_votes", "_forest_root"
_NODE = ("node", "feature", "threshold", "left", "right", "counts")
_OF = [f"_forest_{c}" for c in _NODE]
_CHAINED = 8  # trees that rows go through before they are written
_SCRAMBLE = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # constants of splitmix64


@dataclass(frozen=True)
class DeepForest:
    """A fitted forest. ``nodes`` has one row per node: root -1 for the upper part of a tree, else the
    node of that part which the subtree continues. Leaves have feature -1 and hold their class counts.
    """

    features: list[str]
    classes: list[str]
    trees: int
    nodes: DataFrame

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.features, self.classes, self.trees)], "features array<string>, classes array<string>, trees int").write.mode(
            "overwrite").parquet(f"{path}/params")

    @staticmethod
    def load(spark: SparkSession, path: str) -> DeepForest:
        p = spark.read.parquet(f"{path}/params").first()
        return DeepForest(list(p["features"]), list(p["classes"]), p["trees"], spark.read.parquet(f"{path}/nodes"))


def scrambled(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + np.uint64(_SCRAMBLE[0])
        x = (x ^ (x >> np.uint64(30))) * np.uint64(_SCRAMBLE[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(_SCRAMBLE[2])
        return x ^ (x >> np.uint64(31))


#: Chances that a Poisson variable of mean 1 is at most 0, 1, 2, ...
_UP_TO = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])


def weights(keys: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """How often each row counts in a tree."""
    if not bootstrap:
        return np.ones(len(keys), np.int64)
    tag = scrambled(np.array([seed * 1_000_003 + tree], np.uint64))
    chance = (scrambled(keys ^ tag) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.searchsorted(_UP_TO, chance, side="right").astype(np.int64)


def drawn_features(width: int, seed: int, tree: int, node: int) -> list[int]:
    """All features in the order in which a node of the upper part looks at them."""
    return np.random.default_rng([seed, tree, node]).permutation(width).tolist()


def _rows_of(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = batch.column("x").flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
    return np.where(np.isnan(x), -np.inf, x), batch.column("y").to_numpy(), batch.column("key").to_numpy().view(np.uint64)


def walk(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, x: np.ndarray, start: int = 0) -> np.ndarray:
    """The leaf that each row reaches."""
    at, moving, rows = np.full(len(x), start, np.intp), np.arange(len(x)), np.arange(len(x))
    while len(moving):
        here = at[moving]
        moving, here = moving[feature[here] >= 0], here[feature[here] >= 0]
        below = x[rows[moving], feature[here]] <= threshold[here]
        at[moving] = np.where(below, left[here], right[here])
    return at


def _packed(values: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    values = np.ascontiguousarray(values)
    offsets = np.arange(len(values) + 1, dtype=np.int32) * (values.shape[1] * values.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _opened(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """The matrix whose rows lie in a binary column, read in place."""
    if not len(column):
        return np.zeros((0, width), kind)
    begin = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    return np.frombuffer(column.buffers()[2], kind, len(column) * width, begin).reshape(-1, width)


_CELLS = "key long, y int, bins binary, w long"


def _binner(edges: list[list[float]], bootstrap: bool):
    """Class, bins and weight of the rows. Without a bootstrap, rows of one class and equal bins are one cell."""
    width = len(edges)

    def cells(y: np.ndarray, bins: np.ndarray, keys: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(y, pa.int32()), _packed(bins), pa.array(w)], names=["key", "y", "bins", "w"])

    def merged(parts: list[np.ndarray]) -> pa.RecordBatch:
        both = np.ascontiguousarray(np.concatenate(parts))
        found, counts = np.unique(both.view(f"V{2 * (width + 1)}").ravel(), return_counts=True)
        found = found.view(np.uint16).reshape(-1, width + 1)
        return cells(found[:, width], found[:, :width], np.zeros(len(found), np.uint64), counts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, keys = _rows_of(batch, width)
            bins = bin_numbers(np.where(np.isinf(x), np.nan, x), edges)
            if bootstrap:
                yield cells(y, bins, keys, np.ones(len(y), np.int64))
                continue
            held.append(np.column_stack([bins, y.astype(np.uint16)]))
            if sum(map(len, held)) >= _MERGED:
                yield merged(held)
                held = []
        if held:
            yield merged(held)

    return pack


def _counter(uppers: list[dict], open_: dict[tuple[int, int], list[int]], edges: list[list[float]], classes: int, seed: int, bootstrap: bool):
    """Class counts per (tree, node, feature, bin) of the open nodes; ``open_`` names the features each looks at."""
    most = max(len(e) for e in edges) + 2
    asked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for t in {tree for tree, _ in open_}:
        nodes = np.array(sorted(n for tree, n in open_ if tree == t))
        look = np.full((len(nodes), max(len(open_[t, n]) for n in nodes)), -1, np.intp)
        for i, n in enumerate(nodes):
            look[i, : len(open_[t, n])] = open_[t, n]
        asked[t] = nodes, look

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((*look.shape, most * classes), np.int64) for t, (_, look) in asked.items()}
        for batch in batches:
            bins = _opened(batch.column("bins"), len(edges), np.uint16)
            y, keys, held = batch.column("y").to_numpy(), batch.column("key").to_numpy().view(np.uint64), batch.column("w").to_numpy()
            for t, (nodes, look) in asked.items():
                at, w = walk(*uppers[t]["cuts"], bins), weights(keys, t, seed, bootstrap) * held
                place = np.full(len(uppers[t]["cuts"][0]), -1, np.intp)
                place[nodes] = np.arange(len(nodes))
                here = np.flatnonzero((place[at] >= 0) & (w > 0))
                slot = place[at[here]]
                for i in range(look.shape[1]):
                    j = look[slot, i]
                    some, of = here[j >= 0], slot[j >= 0]
                    np.add.at(sums[t], (of, i, bins[some, j[j >= 0]].astype(np.intp) * classes + y[some]), w[some])
        for t, (nodes, look) in asked.items():
            table = sums[t].reshape(*look.shape, most, classes)
            n, i, b = np.nonzero(table.sum(axis=3))
            if len(n):
                columns = [np.full(len(n), t), nodes[n], look[n, i], b]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int32()) for c in columns], *[pa.array(table[n, i, b, k]) for k in range(classes)]],
                    names=["tree", "node", "feature", "bin", *[f"c{k}" for k in range(classes)]])

    return count


def _best(cells: DataFrame, classes: int) -> DataFrame:
    """Per (tree, node): class counts, and the cut of least Gini impurity with the counts on its left."""
    whole = Window.partitionBy("tree", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    names = [f"c{k}" for k in range(classes)]
    sums = cells.select("tree", "node", "feature", "bin", F.array(*[F.sum(c).over(upto) for c in names]).alias("left"), F.array(*[F.sum(c).over(whole) for c in names]).alias("all"))

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("long"), lambda a, v: a + v)

    def purity(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0.0), lambda a, v: a + v.cast("double") * v) / total(counts)

    right = F.zip_with("all", "left", lambda a, b: a - b)
    cut = F.struct((purity(F.col("left")) + purity(right)).alias("score"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "left")
    return sums.groupBy("tree", "node").agg(F.max("all").alias("counts"), F.max(F.when(total(F.col("left")) < total(F.col("all")), cut)).alias("cut"))


def _draws(rng: np.random.Generator, width: int) -> Iterator[list[int]]:
    """The orders that calls of ``rng.permutation(width)`` give, many at once."""
    while True:
        yield from rng.permuted(np.tile(np.arange(width), (256, 1)), axis=1).tolist()


def _few_rows(x: list[list[float]], y: list[int], w: list[float], here: list[int], counts: list[float], order: list[int], look: int):
    """The best (score, feature, threshold) of a node of few rows: sums of whole numbers, so the same as of arrays."""
    best, seen = None, 0
    for j in order:
        ordered = sorted((x[i][j], i) for i in here)
        if ordered[0][0] == ordered[-1][0]:
            continue
        below, above = [0.0] * len(counts), list(counts)
        under, over = 0.0, sum(counts)
        found = None
        last = None
        for v, i in ordered:
            if last is not None and v != last:
                score = sum([c * c for c in below]) / under + sum([c * c for c in above]) / over
                if found is None or score > found[0]:
                    found = (score, last, v)
            c, n = y[i], w[i]
            below[c] += n
            above[c] -= n
            under += n
            over -= n
            last = v
        if best is None or found[0] > best[0]:
            _, low, high = found
            middle = low / 2 + high / 2
            best = (found[0], j, middle if low < middle < high else low)
        seen += 1
        if seen == look:
            break
    return best


def _many_rows(x: np.ndarray, shares: np.ndarray, here: np.ndarray, counts: np.ndarray, order: list[int], look: int):
    best, seen = None, 0
    for j in order:
        v = x[here, j]
        ordered = np.argsort(v, kind="stable")
        v = v[ordered]
        cuts = np.flatnonzero(v[1:] != v[:-1])
        if not len(cuts):
            continue
        below = np.cumsum(shares[here[ordered]], axis=0)[cuts]
        above = counts - below
        score = (below**2).sum(axis=1) / below.sum(axis=1) + (above**2).sum(axis=1) / above.sum(axis=1)
        i = int(score.argmax())
        if best is None or score[i] > best[0]:
            low, high = float(v[cuts[i]]), float(v[cuts[i] + 1])
            middle = low / 2 + high / 2
            best = (score[i], j, middle if low < middle < high else low)
        seen += 1
        if seen == look:
            break
    return best


def grow_exact(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, look: int, rng: np.random.Generator) -> list[tuple]:
    """(feature, threshold, left, right, counts) of a tree grown until every leaf is pure or all its rows are equal."""
    nodes: list[tuple] = [()]
    todo: list[tuple] = [(0, np.arange(len(y)))]
    shares = np.zeros((len(y), classes))
    shares[np.arange(len(y)), y] = w
    draws = _draws(rng, x.shape[1])
    numbers, labels, held = x.tolist(), y.tolist(), [float(v) for v in w]
    while todo:
        slot, here = todo.pop()
        few = len(here) <= _FEW
        if few:
            here = here if isinstance(here, list) else here.tolist()
            counts = [0.0] * classes
            for i in here:
                counts[labels[i]] += held[i]
            mixed = sum([c != 0 for c in counts]) > 1
            best = _few_rows(numbers, labels, held, here, counts, next(draws), look) if mixed else None
        else:
            total = shares[here].sum(axis=0)
            counts = total.tolist()
            best = _many_rows(x, shares, here, total, next(draws), look) if np.count_nonzero(total) > 1 else None
        if best is None:
            nodes[slot] = (-1, 0.0, slot, slot, counts)
            continue
        _, j, t = best
        nodes[slot] = (j, t, len(nodes), len(nodes) + 1, None)
        if few:
            left, right = [i for i in here if numbers[i][j] <= t], [i for i in here if not numbers[i][j] <= t]
        else:
            below = x[here, j] <= t
            left, right = here[below], here[~below]
        todo += [(len(nodes), left), (len(nodes) + 1, right)]
        nodes += [(), ()]
    return nodes


def _lists(values: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    """Each row's numbers as one list; null where not ``known``."""
    kept = values if known is None else values[known]
    sizes = np.full(len(values), values.shape[1]) if known is None else np.where(known, values.shape[1], 0)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(kept.ravel(), pa.float64()), mask=None if known is None else pa.array(~known))


def _merged_rows(y: np.ndarray, w: np.ndarray, x: np.ndarray, *of: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different rows among some, with the sum of their weights."""
    width = x.shape[1]
    # Whole numbers beside the bits of the doubles; 0.0 and -0.0 are one number.
    both = np.column_stack([*[c.astype(np.int64) for c in (*of, y)], np.ascontiguousarray(x + 0.0, np.float64).view(np.int64)])
    found, place = np.unique(both.view(f"V{8 * both.shape[1]}").ravel(), return_inverse=True)
    found = found.view(np.int64).reshape(len(found), -1)
    numbers = np.ascontiguousarray(found[:, -width:]).view(np.float64)
    return (found[:, len(of)], np.bincount(place, w, len(found)).astype(np.int64), numbers, *(found[:, i] for i in range(len(of))))


def _deal(uppers: list[dict], ends: list[dict[int, bool]], width: int, seed: int, bootstrap: bool):
    """Rows of the small nodes, once per tree in which they count; equal rows of a task's stretch as one."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = [np.zeros(len(u["arrays"][0]), bool) for u in uppers]
        for t, some in enumerate(ends):
            small[t][[n for n, is_small in some.items() if is_small]] = True

        def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x, y, keys = (np.concatenate(c) for c in zip(*[_rows_of(batch, width) for batch in held]))
            for t, upper in enumerate(uppers):
                at, w = walk(*upper["arrays"], x), weights(keys, t, seed, bootstrap)
                here = np.flatnonzero(small[t][at] & (w > 0))
                if len(here):
                    some, times, numbers, root = _merged_rows(y[here], w[here], x[here], at[here])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(some), t), pa.int32()), pa.array(root, pa.int32()), pa.array(some, pa.int32()), pa.array(times),
                        _packed(numbers)], names=["tree", "root", "y", "w", "x"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch] if batch.num_rows else []
            if sum(b.num_rows for b in held) >= _MERGED:
                yield from dealt(held)
                held = []
        if held:
            yield from dealt(held)

    return deal


def _groups(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """The rows of each group, by whose whole numbers they come sorted, piece by piece."""
    for batch in batches:
        numbers = [batch.column(c).to_numpy() for c in by]
        cut = np.flatnonzero(np.any([np.diff(n) != 0 for n in numbers], axis=0)) + 1
        for begin, end in zip([0, *cut], [*cut, batch.num_rows]):
            if begin < end:
                yield tuple(int(n[begin]) for n in numbers), batch.slice(begin, end - begin)


def _grower(width: int, classes: int, look: int, seed: int):
    """Grows each (tree, root) of rows that come sorted by it; a group holds few rows."""
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, pieces in groupby(_groups(batches, "tree", "root"), key=lambda g: g[0]):
            rows = pa.Table.from_batches([piece for _, piece in pieces])
            x = np.concatenate([_opened(piece, width, np.float64) for piece in rows["x"].chunks])
            y, w, x = _merged_rows(rows["y"].to_numpy(), rows["w"].to_numpy(), x)
            nodes = grow_exact(x, y, w, classes, look, np.random.default_rng([seed, *of, 1]))
            feature, threshold, left, right, counts = zip(*nodes)
            k = len(nodes)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(k, of[0]), pa.int32()), pa.array(np.full(k, of[1]), pa.int32()), pa.array(np.arange(k), pa.int32()), pa.array(feature, pa.int32()),
                pa.array(threshold, pa.float64()), pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(counts, pa.list_(pa.float64()))],
                names=[c.split()[0] for c in NODES.split(", ")])

    return grow


def fit(
    df: DataFrame, features: Sequence[str], label: str = "label", key: str | None = None, trees: int = TREES, bootstrap: bool = True,
    look: int | None = None, seed: int = SEED, fit_rows: int = FIT_ROWS, small: int = SMALL_ROWS, bins: int = BINS,
) -> DeepForest:
    """Grow the forest; classes are the distinct labels as text, in order. ``key`` tells rows apart for the bootstrap."""
    spark = df.sparkSession
    place = fx.named(key) if key else F.struct(*[fx.named(c) for c in (*features, label)])
    rows = df.filter(fx.named(label).isNotNull()).select(F.xxhash64(place).alias("key"), fx.named(label).cast("string").alias("label"), *[fx.named(c).alias(f"f{i}") for i, c in enumerate(features)])
    total = rows.count()
    if not total:
        raise ValueError("cannot grow a forest without labelled rows")
    if total > fit_rows:
        rows = rows.filter(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * fit_rows / total))
    classes = sorted(r[0] for r in rows.select("label").distinct().limit(MAX_CLASSES + 1).collect())
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    width, k = len(features), len(classes)
    look = look or max(1, math.isqrt(width))
    names = [f"f{i}" for i in range(width)]
    edges = feature_edges(rows, names, bins)
    index = F.array_position(F.array(*map(F.lit, classes)), F.col("label")) - 1
    rows = materialize(spread(rows.select("key", index.cast("int").alias("y"), packed_array(names).alias("x")), total), "forest-rows")

    # The upper part of each tree: lists that grow, and arrays of them for the tasks.
    uppers = [{"nodes": [[-1, 0.0, 0, 0, 0]], "arrays": None, "cuts": None} for _ in range(trees)]
    binned: DataFrame | None = None
    counts: dict[tuple[int, int], list[float]] = {}
    ends: list[dict[int, bool]] = [{} for _ in range(trees)]
    tried: dict[tuple[int, int], int] = {}
    size = rows.count()
    if size <= small:
        for e in ends:
            e[0] = True
    else:
        tried = {(t, 0): 0 for t in range(trees)}
    while True:
        for u in uppers:
            kinds = (np.intp, np.float64, np.intp, np.intp, np.intp)
            feature, threshold, left, right, cut = (np.array(c, kind) for c, kind in zip(zip(*u["nodes"]), kinds))
            # Rows are walked by their bins here: x <= edges[b - 1] is bin <= b.
            u["arrays"], u["cuts"] = (feature, threshold, left, right), (feature, cut, left, right)
        if not tried:
            break
        if binned is None:
            binned = rows.mapInArrow(_binner(edges, bootstrap), _CELLS)
            if not bootstrap:
                binned = binned.groupBy("y", "bins").agg(F.min("key").alias("key"), F.sum("w").alias("w")).select("key", "y", "bins", "w")
            binned = materialize(binned, "forest-cells")
        asked = {(t, n): drawn_features(width, seed, t, n)[i * look : (i + 1) * look] for (t, n), i in tried.items()}
        cells = binned.mapInArrow(_counter([{"cuts": u["cuts"]} for u in uppers], asked, edges, k, seed, bootstrap),
                                "tree int, node int, feature int, bin int, " + ", ".join(f"c{i} long" for i in range(k)))
        cells = cells.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)])
        # One row per open node, of which there are at most trees * rows / small.
        found = {(r["tree"], r["node"]): r for r in _best(cells, k).collect()}
        following: dict[tuple[int, int], int] = {}
        for (t, n), i in sorted(tried.items()):
            r = found.get((t, n))
            if r is None:  # no row counts in this tree
                counts[t, n] = [0.0] * k
            elif r["cut"] is None:
                # Equal in the features seen so far: look at the next ones; bins may also hide what exact values tell.
                if (i + 1) * look < width:
                    following[t, n] = i + 1
                else:
                    ends[t][n] = True
            else:
                j, b = -r["cut"]["feature"], -r["cut"]["bin"]
                nodes = uppers[t]["nodes"]
                left, right = len(nodes), len(nodes) + 1
                nodes[n] = [j, edges[j][b - 1] if 0 < b <= len(edges[j]) else -math.inf, left, right, b]
                nodes += [[-1, 0.0, left, left, 0], [-1, 0.0, right, right, 0]]
                below = list(r["cut"]["left"])
                for child, held in ((left, below), (right, [a - c for a, c in zip(r["counts"], below)])):
                    if sum(v > 0 for v in held) <= 1:
                        counts[t, child] = [float(v) for v in held]
                    elif sum(held) <= small:
                        ends[t][child] = True
                    else:
                        following[t, child] = 0
        tried = following

    upper = [(t, -1, n, int(j), float(c), left, right, counts.get((t, n))) for t, u in enumerate(uppers) for n, (j, c, left, right, _) in enumerate(u["nodes"])]
    dealt = rows.mapInArrow(_deal([{"arrays": u["arrays"]} for u in uppers], ends, width, seed, bootstrap), "tree int, root int, y int, w long, x binary")
    tasks = max(sum(len(e) for e in ends) // 8, 1)
    grown = dealt.repartition(min(tasks, 2000), "tree", "root").sortWithinPartitions("tree", "root").mapInArrow(_grower(width, k, look, seed), NODES)
    nodes = materialize(spark.createDataFrame(upper, NODES).unionByName(grown), "forest-nodes")
    return DeepForest(list(features), classes, trees, nodes)


def _joined(nodes, classes: int) -> tuple[np.ndarray, ...]:
    """Roots and arrays of some whole trees: subtrees take the places of the nodes they continue."""
    nodes = nodes.sort_values(["tree", "root", "node"], ignore_index=True)
    begins = nodes.index[nodes["node"] == 0]
    group = dict(zip(zip(nodes["tree"][begins], nodes["root"][begins]), begins))
    offset = np.repeat(begins.to_numpy(), np.diff([*begins, len(nodes)]))
    left, right = (nodes[c].to_numpy() + offset for c in ("left", "right"))
    feature, threshold = nodes["feature"].to_numpy().astype(np.intp), nodes["threshold"].to_numpy(dtype="float64")
    shares = np.zeros((len(nodes), classes))
    for i in np.flatnonzero(nodes["counts"].notna()):
        held = np.asarray(nodes["counts"][i], np.float64)
        shares[i] = held / (held.sum() or 1.0)
    moved = np.arange(len(nodes))
    for (t, root), begin in group.items():
        if root >= 0:
            moved[group[t, -1] + root] = begin
    roots = np.array([moved[group[t, -1]] for t in sorted({t for t, _ in group})])
    return roots, feature, threshold, moved[left].astype(np.intp), moved[right].astype(np.intp), shares


def _votes(forest: DeepForest, first: int, last: int) -> Column:
    spark, classes = forest.nodes.sparkSession, len(forest.classes)
    held = forest.nodes.filter(F.col("tree").between(first, last)).toPandas()
    shared = spark.sparkContext.broadcast(_joined(held, classes))
    width = len(forest.features)

    @F.arrow_udf("array<double>")
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        roots, feature, threshold, left, right, shares = shared.value
        for batch in batches:
            x = batch.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(batch), width)
            x = np.where(np.isnan(x), -np.inf, x)
            total = np.zeros((len(batch), classes))
            for root in roots:
                total += shares[walk(feature, threshold, left, right, x, int(root))]
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * classes, pa.int32()), pa.array(total.ravel()))

    return vote(packed_array(forest.features))


def _counts_of(nodes, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Class shares of the nodes, and which of them are leaves that hold counts."""
    known = nodes["counts"].notna().to_numpy()
    counts = np.zeros((len(nodes), classes))
    if known.any():
        counts[known] = np.stack(nodes["counts"][known].to_numpy())
    total = counts.sum(axis=1, keepdims=True)
    return counts / np.where(total > 0, total, 1.0), known


def _gathered(pieces: Iterator[pa.RecordBatch], rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Small pieces as batches of at least ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for piece in pieces:
        held.append(piece)
        if sum(p.num_rows for p in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _placer(upper: tuple | None, kept: Sequence[str], width: int, classes: int, trees: int):
    """The root in the next tree where each row goes on; where it ends in the upper part, its shares are added there.

    Without a next tree the sums of shares become probabilities.
    """
    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c) for c in kept]
        x, votes = batch.column(_X), _opened(batch.column(_VOTES), classes, np.float64)
        if upper is None:
            return pa.RecordBatch.from_arrays([*columns, _lists(votes / trees)], names=[*kept, "probabilities"])
        arrays, shares, known = upper
        at = walk(*arrays, _opened(x, width, np.float64))
        # Rows that have ended are dealt out evenly, as nothing has to meet them.
        root = np.where(known[at], -1 - np.arange(len(at)) * 64 // max(len(at), 1), at)
        votes = votes + np.where(known[at, None], shares[at], 0.0)
        return pa.RecordBatch.from_arrays([*columns, x, _packed(votes), pa.array(root, pa.int32())], names=[*kept, _X, _VOTES, _ROOT])

    return place


def _starter(place, kept: Sequence[str], width: int, classes: int):
    """Rows at their roots in the first tree."""
    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(_X).flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, width)
            packed = _packed(np.where(np.isnan(x), -np.inf, x).astype(np.float64, copy=False))
            yield place(pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], packed, _packed(np.zeros((batch.num_rows, classes)))], names=[*kept, _X, _VOTES]))

    return start


def _finisher(place, kept: Sequence[str], width: int, classes: int):
    """Adds the shares of rows that come sorted by root, each group behind the nodes it goes on with, and places them anew."""
    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for root, pieces in groupby(_groups(batches, _ROOT), key=lambda g: g[0]):
            held: list[pa.RecordBatch] = []
            arrays = shares = None
            for _, piece in pieces:
                is_node = piece.column(_OF[0]).is_valid().to_numpy(zero_copy_only=False)
                if is_node.any():
                    held.append(piece.filter(pa.array(is_node)))
                    piece = piece.filter(pa.array(~is_node))
                if not piece.num_rows:
                    continue
                votes = piece.column(_VOTES)
                if root[0] >= 0:
                    if arrays is None:
                        nodes = pa.Table.from_batches(held).select(_OF).to_pandas().set_axis(_NODE, axis=1).sort_values("node", ignore_index=True)
                        arrays = (nodes["feature"].to_numpy(np.intp), nodes["threshold"].to_numpy(np.float64), nodes["left"].to_numpy(np.intp), nodes["right"].to_numpy(np.intp))
                        shares, held = _counts_of(nodes, classes)[0], []
                    at = walk(*arrays, _opened(piece.column(_X), width, np.float64))
                    votes = _packed(_opened(votes, classes, np.float64) + shares[at])
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in kept], piece.column(_X), votes], names=[*kept, _X, _VOTES])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(ended(batches)):
            yield place(batch)

    return finish


def _routed(df: DataFrame, forest: DeepForest) -> DataFrame:
    """``probabilities`` by a forest too large to be sent whole: rows meet the subtrees they go on with, tree after tree.

    Only the upper parts, about rows / small nodes a tree, are sent to all tasks. Each tree shuffles the rows once, with the
    sums of their shares so far, so they need no numbers and no join.
    """
    width, classes, kept = len(forest.features), len(forest.classes), df.columns
    top = forest.nodes.filter("root = -1").toPandas().sort_values(["tree", "node"], ignore_index=True)
    uppers = []
    for _, u in top.groupby("tree", sort=True):
        u = u.reset_index(drop=True)
        uppers.append(((u["feature"].to_numpy(np.intp), u["threshold"].to_numpy(np.float64), u["left"].to_numpy(np.intp), u["right"].to_numpy(np.intp)), *_counts_of(u, classes)))
    places = [_placer(u, kept, width, classes, forest.trees) for u in [*uppers, None]]
    own = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    placed = T.StructType([*own, T.StructField(_X, T.BinaryType()), T.StructField(_VOTES, T.BinaryType()), T.StructField(_ROOT, T.IntegerType())])
    done = T.StructType([*own, T.StructField("probabilities", T.ArrayType(T.DoubleType()))])
    kinds = dict(zip(_OF, ("int", "int", "double", "int", "int", "array<double>")))
    rows = df.withColumn(_X, packed_array(forest.features)).mapInArrow(_starter(places[0], kept, width, classes), placed)
    for t, (_, _, known) in enumerate(uppers):
        if t and t % _CHAINED == 0:
            rows = materialize(rows, "forest-routed")
        subtrees = forest.nodes.filter((F.col("tree") == t) & (F.col("root") >= 0)).select(F.col("root").alias(_ROOT), *[F.col(c).alias(n) for c, n in zip(_NODE, _OF)])
        both = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items()}).unionByName(subtrees, allowMissingColumns=True)
        # A fixed number of tasks: the rows are small but slow work, which adaptive execution would put into few tasks.
        tasks = min(max(len(known) // 16, df.sparkSession.sparkContext.defaultParallelism), 2000)
        met = both.repartition(tasks, _ROOT).sortWithinPartitions(_ROOT, F.asc_nulls_last(_OF[0]))
        rows = met.mapInArrow(_finisher(places[t + 1], kept, width, classes), done if t + 1 == len(uppers) else placed)
    return rows


def predict(df: DataFrame, forest: DeepForest, prediction: str = "prediction", confidence: str = "confidence_score") -> DataFrame:
    """The class of the greatest mean leaf share (the first of equal ones), that share, and all shares."""
    sizes = {r["tree"]: r["n"] for r in forest.nodes.groupBy("tree").agg(F.count("*").alias("n")).collect()}
    if max(sizes.values()) > GROUP_NODES:
        return _decided(_routed(df, forest), forest, prediction, confidence)
    groups, begun, held = [], 0, 0
    for t in range(forest.trees):
        if held and held + sizes[t] > GROUP_NODES:
            groups.append((begun, t - 1))
            begun, held = t, 0
        held += sizes[t]
    groups.append((begun, forest.trees - 1))
    total = F.array(*[F.lit(0.0)] * len(forest.classes))
    for first, last in groups:
        total = F.zip_with(total, _votes(forest, first, last), lambda a, b: a + b)
    return _decided(df.withColumn("probabilities", F.transform(total, lambda v: v / forest.trees)), forest, prediction, confidence)


def _decided(scored: DataFrame, forest: DeepForest, prediction: str, confidence: str) -> DataFrame:
    top = F.array_max("probabilities")
    name = F.get(F.array(*map(F.lit, forest.classes)), (F.array_position("probabilities", top) - 1).cast("int"))
    return scored.withColumns({prediction: name, confidence: top})
