"""Hard negatives by a multiway hyperplane tree with distance ranges, in the manner of GNAT.

Vectors become whole numbers, floor(256 * entry), and scores are their exact inner products. A tree
is fitted on a bounded sample (``SAMPLE_ROWS``, ``SAMPLE_BYTES``): every node has up to ``FANOUT`` split
points, chosen far apart, and every vector belongs to the nearest one. All vectors are indexed: they
are dealt to the leaf cells and packed into leaf blocks, large cells into many. Each block, cell and
subtree knows the range of distances from each split point of the nodes above to its vectors, and the
range of their lengths.

A query is a window of scores. By |a - x|^2 = |a|^2 + |x|^2 - 2<a, x> it is an annulus round the
anchor; a subtree whose range to any split point does not meet the annulus, by the triangle
inequality, is left out with all below it. What remains is scored exactly, so results are exact. The
first search (window: all scores, same label) finds an anchor's positives, the second one the best
rows of other labels inside each positive's window. The k-th best score of the sample, and of the
blocks seen so far, narrows the windows from below.

Anchors meet the blocks as packed query blocks: broadcast up to ``BROADCAST_BYTES``, beyond that by a
join on (query part, block group). Every task keeps k rows per window, and only rows above the sample's
k-th score leave it; a window over (anchor, positive) takes the k best of all.

Rows with a null id, label or vector, or with a null or non-finite entry, take no part. Neither do
vectors whose whole numbers have a length of 2**29 or more, as scores might not fit a long. Vectors
of different length are not compared. Repeated rows and rows that share an id each count: every row
whose id is divisible by ``every`` is an anchor of its own, and all rows but itself are candidates. Ties go to the
smaller id. Anchors without positives or without negatives give no rows, and so does an empty table.
Input columns beyond id, vector and label are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.llm.common import broadcast_value, materialize, shared_value, table

FANOUT = 16
#: The tree is fitted on at most this many vectors, and this many bytes of them.
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 32 << 20
#: Cells of about this many rows are aimed at, in at most so many levels.
CELL_ROWS, LEVELS = 4096, 3
#: Rows of a leaf block, and its bytes.
LEAF_ROWS, LEAF_BYTES = 1024, 4 << 20
#: A cell with more rows is dealt to several tasks.
GROUP_ROWS = 8192
QUERY_ROWS = 512
#: Rows times windows that are compared at once.
MARKS = 1 << 20
BROADCAST_BYTES = 64 << 20
LONGEST = 2.0**29
#: Integers below this are exact as doubles.
EXACT = 2.0**53
LOWEST, HIGHEST = -(2**62), 2**62
SLACK = 1e-12
BLOCKS = "dim int, cell int, n int, rows binary, ids binary, labels binary, vectors binary, low array<double>, high array<double>"
FOUND = "anchor bigint, part int, score bigint, id bigint, row bigint"


def whole_rows(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(row, id, label, q): valid rows with whole-number vectors; ``row`` tells rows apart once written."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                     F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(256 * x) < LONGEST))
    square = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.withColumn("q", F.transform("v", lambda x: F.floor(x * 256))).where(square < LONGEST**2).select(
        F.monotonically_increasing_id().alias("row"), "id", "label", "q")


def scores(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, as int64."""
    def length(m: np.ndarray) -> float:
        return float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)).max(initial=0.0))

    if length(x) * length(a) * 1.01 < EXACT:
        return (x.astype(np.float64) @ a.T.astype(np.float64)).astype(np.int64)
    return x @ a.T


def squares(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(axis=1)


def distance_bounds(x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of rows and points, from below and from above, each less or more than any rounding error."""
    xx, pp = squares(x)[:, None], squares(points)[None, :]
    middle = xx + pp - 2 * (x.astype(np.float64) @ points.T.astype(np.float64))
    slack = SLACK * (xx + pp)
    return np.sqrt(np.maximum(middle - slack, 0)), np.sqrt(np.maximum(middle + slack, 0))


def grow(sample: np.ndarray, levels: int, seed: int = 3) -> dict:
    """Split points of all nodes, and for each cell the path of (node, child) to it."""
    r = np.random.default_rng(seed)
    points: list[np.ndarray] = []
    children: list[list[int]] = []
    paths: list[list[tuple[int, int]]] = []

    def split(rows: np.ndarray, level: int, path: list[tuple[int, int]]) -> int:
        """Number of the node, or -1 - cell."""
        apart = _far_apart(rows, r) if level < levels and len(rows) > FANOUT else []
        if len(apart) < 2:
            paths.append(path)
            return -len(paths)
        me = len(points)
        points.append(rows[apart])
        children.append([])
        nearest = distance_bounds(rows, points[me])[1].argmin(axis=1)
        for j in range(len(apart)):
            children[me].append(split(rows[nearest == j], level + 1, [*path, (me, j)]))
        return me

    root = split(sample, 0, [])
    return {"points": points, "children": children, "paths": paths, "root": root}


def _far_apart(rows: np.ndarray, r: np.random.Generator) -> list[int]:
    """Up to FANOUT of some random rows, each as far as possible from those before."""
    some = r.permutation(len(rows))[: 8 * FANOUT]
    chosen = [0]
    gap = distance_bounds(rows[some], rows[some[:1]])[0][:, 0]
    while len(chosen) < FANOUT:
        k = int(gap.argmax())
        if gap[k] <= 0:
            break
        chosen.append(k)
        gap = np.minimum(gap, distance_bounds(rows[some], rows[some[k : k + 1]])[0][:, 0])
    return [int(some[k]) for k in chosen]


def cells_of(tree: dict | None, x: np.ndarray) -> np.ndarray:
    cells = np.zeros(len(x), np.int32)
    todo = [(tree["root"], np.arange(len(x)))] if tree else []
    while todo:
        node, at = todo.pop()
        if node < 0:
            cells[at] = -1 - node
        elif len(at):
            nearest = distance_bounds(x[at], tree["points"][node])[1].argmin(axis=1)
            todo += [(child, at[nearest == j]) for j, child in enumerate(tree["children"][node])]
    return cells


def ranges(tree: dict | None, cell: int, x: np.ndarray) -> tuple[list[float], list[float]]:
    """Least and greatest length of the rows, then distance to each split point above them, in order."""
    lengths = np.sqrt(squares(x))
    low, high = [lengths.min() * (1 - SLACK)], [lengths.max() * (1 + SLACK)]
    for node, _ in tree["paths"][cell] if tree else []:
        below, above = distance_bounds(x, tree["points"][node])
        low += below.min(axis=0).tolist()
        high += above.max(axis=0).tolist()
    return low, high


def vectors_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat numbers and offsets of a list column without nulls."""
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _deal(shared):
    """Adds each vector's length and cell."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared_value(shared)
        for batch in batches:
            flat, edges = vectors_in(batch.column("q"))
            dims = np.diff(edges)
            cells = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if dim in trees:
                    cells[at] = cells_of(trees[int(dim)], flat[edges[at][:, None] + np.arange(dim)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims, pa.int32()), pa.array(cells)], names=[*batch.schema.names, "dim", "cell"])

    return deal


def _pack(shared):
    """Leaf blocks of rows that come sorted by vector length and cell."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared_value(shared)
        held: list[np.ndarray] = []
        of = (-1, -1)

        def block() -> pa.RecordBatch:
            rows, ids, labels, x = (np.concatenate([h[i] for h in held]) for i in range(4))
            low, high = ranges(trees.get(of[0]), of[1], x)
            return pa.RecordBatch.from_arrays([
                pa.array([of[0]], pa.int32()), pa.array([of[1]], pa.int32()), pa.array([len(rows)], pa.int32()),
                *[pa.array([v.astype(np.int64).tobytes()], pa.binary()) for v in (rows, ids, labels, x)],
                pa.array([low], pa.list_(pa.float64())), pa.array([high], pa.list_(pa.float64()))],
                names=["dim", "cell", "n", "rows", "ids", "labels", "vectors", "low", "high"])

        for batch in batches:
            if not batch.num_rows:
                continue
            flat, edges = vectors_in(batch.column("q"))
            rows, ids, labels, dims, cells = (batch.column(c).to_numpy() for c in ("row", "id", "label", "dim", "cell"))
            cut = np.flatnonzero((np.diff(dims) != 0) | (np.diff(cells) != 0)) + 1
            for begin, end in zip([0, *cut], [*cut, len(rows)]):
                key = (int(dims[begin]), int(cells[begin]))
                if held and key != of:
                    yield block()
                    held = []
                of = key
                most = max(16, min(LEAF_ROWS, LEAF_BYTES // (8 * key[0] + 8)))
                while begin < end:
                    stop = min(end, begin + most - sum(len(h[0]) for h in held))
                    held.append((rows[begin:stop], ids[begin:stop], labels[begin:stop], flat[edges[begin] : edges[stop]].reshape(stop - begin, key[0])))
                    begin = stop
                    if sum(len(h[0]) for h in held) == most:
                        yield block()
                        held = []
        if held:
            yield block()

    return pack


class Queries:
    """Anchors of one query block with their windows, whose lower ends rise as rows are found."""

    def __init__(self, packed: dict, k: int, same: bool):
        self.k, self.same, self.dim = k, same, packed["dim"]
        self.rows, self.labels = (np.frombuffer(packed[c], np.int64) for c in ("rows", "labels"))
        self.a = np.frombuffer(packed["vectors"], np.int64).reshape(len(self.rows), self.dim)
        self.owner, self.part, low, self.high = (np.frombuffer(packed[c], np.int64) for c in ("owner", "part", "low", "high"))
        self.low = low.copy()
        self.square = squares(self.a)
        # The best rows so far: window, score, id, row.
        self.best = np.zeros((4, 0), np.int64)

    def annuli(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that any window of each anchor still asks for; none: greatest below least."""
        low, high = np.full(len(self.rows), HIGHEST), np.full(len(self.rows), LOWEST)
        open_ = self.low <= self.high
        np.minimum.at(low, self.owner[open_], self.low[open_])
        np.maximum.at(high, self.owner[open_], self.high[open_])
        return low.astype(np.float64), high.astype(np.float64)

    def meets(self, at: np.ndarray, near: np.ndarray, far: np.ndarray, lengths: tuple[np.ndarray, np.ndarray],
              low: np.ndarray, high: np.ndarray, asked: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Whether the annulus of each anchor in ``at`` meets each subtree's ranges.

        ``near`` and ``far`` are the anchors' distances to the split points, ``low`` and ``high`` have a row per
        subtree and a column per split point.
        """
        square = self.square[at][:, None]
        lowest, highest = asked[0][at][:, None], asked[1][at][:, None]
        least, most = (v[None, :] ** 2 for v in lengths)
        inner = square + least - 2 * highest
        outer = square + most - 2 * lowest
        slack = SLACK * (square + most)
        inner, outer = np.sqrt(np.maximum(inner - slack - SLACK * np.abs(highest), 0)), outer + slack + SLACK * np.abs(lowest)
        alive = (outer >= 0) & (lowest <= highest)
        outer = np.sqrt(np.maximum(outer, 0))
        for i in range(low.shape[1]):
            beyond = np.maximum(near[:, i : i + 1] - outer, inner - far[:, i : i + 1])
            alive &= (high[None, :, i] >= beyond) & (low[None, :, i] <= far[:, i : i + 1] + outer)
        return alive

    def cells(self, tree: dict | None, known: dict | None) -> np.ndarray:
        """Anchors by cells: whether the cell may hold a row of some window."""
        asked = self.annuli()
        if not tree:
            return (asked[0] <= asked[1])[:, None]
        alive = np.zeros((len(self.rows), len(tree["paths"])), bool)
        todo = [(tree["root"], np.flatnonzero(asked[0] <= asked[1]))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                alive[at, -1 - node] = True
            elif len(at):
                near, far = distance_bounds(self.a[at], tree["points"][node])
                r = known[node]
                ok = self.meets(at, near, far, (r["least"], r["most"]), r["low"], r["high"], asked)
                todo += [(child, at[ok[:, j]]) for j, child in enumerate(tree["children"][node])]
        return alive

    def bound(self, sample: dict) -> None:
        """Raise windows to the k-th best score of the sample's rows, which are indexed as well."""
        found = self.matches(np.arange(len(self.rows)), sample["x"], sample["rows"], sample["ids"], sample["labels"])
        self.raise_to(self.first(found))

    def matches(self, at: np.ndarray, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Rows inside the windows of some anchors."""
        place = np.full(len(self.rows), -1)
        place[at] = np.arange(len(at))
        windows = np.flatnonzero((place[self.owner] >= 0) & (self.low <= self.high))
        out = [np.zeros((4, 0), np.int64)]
        score = scores(x, self.a[at])
        # Few windows at a time, so that the tables stay small.
        step = max(16, MARKS // max(len(rows), 1))
        for i in range(0, len(windows), step):
            w = windows[i : i + step]
            of = self.owner[w]
            s = score[:, place[of]]
            alike = labels[:, None] == self.labels[of][None, :]
            fits = (s >= self.low[w]) & (s <= self.high[w]) & (alike if self.same else ~alike) & (rows[:, None] != self.rows[of][None, :])
            r, c = np.nonzero(fits)
            out.append(np.stack([w[c], s[r, c], ids[r], rows[r]]))
        return np.concatenate(out, axis=1)

    def first(self, found: np.ndarray) -> np.ndarray:
        """The k best rows of each window."""
        found = found[:, np.lexsort((found[3], found[2], -found[1], found[0]))]
        begins = np.searchsorted(found[0], found[0])
        return found[:, np.arange(found.shape[1]) - begins < self.k]

    def raise_to(self, best: np.ndarray) -> None:
        full = np.bincount(best[0], minlength=len(self.low)) >= self.k
        least = np.full(len(self.low), HIGHEST)
        np.minimum.at(least, best[0], best[1])
        self.low = np.where(full, np.maximum(self.low, least), self.low)

    def take(self, block: dict, tree: dict | None, cells: np.ndarray, nodes: dict) -> None:
        cell = block["cell"]
        at = np.flatnonzero(cells[:, cell])
        if not len(at):
            return
        if tree and tree["paths"][cell]:
            if cell not in nodes:
                points = np.concatenate([tree["points"][n] for n, _ in tree["paths"][cell]])
                nodes[cell] = distance_bounds(self.a, points)
            near, far = (d[at] for d in nodes[cell])
        else:
            near = far = np.zeros((len(at), 0))
        low, high = np.array(block["low"]), np.array(block["high"])
        at = at[self.meets(at, near, far, (low[:1], high[:1]), low[None, 1:], high[None, 1:], self.annuli())[:, 0]]
        if not len(at):
            return
        found = self.matches(at, block["x"], block["rows"], block["ids"], block["labels"])
        if found.shape[1]:
            self.best = self.first(np.concatenate([self.best, found], axis=1))
            self.raise_to(self.best)


def opened(row: dict) -> dict:
    ids = np.frombuffer(row["ids"], np.int64)
    return {**row, "ids": ids, "rows": np.frombuffer(row["rows"], np.int64), "labels": np.frombuffer(row["labels"], np.int64),
            "x": np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["dim"])}


def _searcher(shared, k: int, same: bool, queries=None):
    """Searches the blocks for the queries sent along, or else for those joined to each block."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared_value(shared)
        ready: dict[int, tuple[Queries, np.ndarray, dict]] = {}

        def prepared(packed: dict) -> tuple[Queries, np.ndarray, dict]:
            key = packed["qb"]
            if key not in ready:
                asked = Queries(packed, k, same)
                if asked.dim in index["samples"]:
                    asked.bound(index["samples"][asked.dim])
                ready[key] = asked, asked.cells(index["trees"].get(asked.dim), index["ranges"].get(asked.dim)), {}
            return ready[key]

        def told() -> Iterator[pa.RecordBatch]:
            for asked, _, _ in ready.values():
                w, s, ids, rows = asked.best
                for i in range(0, len(w), 100_000):
                    p = slice(i, i + 100_000)
                    columns = [asked.rows[asked.owner[w[p]]], asked.part[w[p]], s[p], ids[p], rows[p]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                        names=["anchor", "part", "score", "id", "row"])
            ready.clear()

        sent = queries.value if queries else None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = opened(row)
                here = [q for q in sent if q["dim"] == row["dim"]] if sent is not None else [{**row["q"], "dim": row["dim"]}]
                # Joined blocks come sorted by query block, so one at a time is held.
                if sent is None and here[0]["qb"] not in ready:
                    yield from told()
                for packed in here:
                    asked, cells, nodes = prepared(packed)
                    asked.take(block, index["trees"].get(row["dim"]), cells, nodes)
        yield from told()

    return search


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("rows", "labels", "vectors", "owner", "part", "low", "high")
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            anchors = row["anchors"]
            windows = [(j, *(w[c] for c in ("part", "low", "high"))) for j, a in enumerate(anchors) for w in a["windows"]]
            lists = [[a["row"] for a in anchors], [a["label"] for a in anchors], [a["q"] for a in anchors], *([w[c] for w in windows] for c in range(4))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["dim"]], pa.int32()), pa.array([row["qb"]], pa.int64()), *[pa.array([np.array(x, np.int64).tobytes()], pa.binary()) for x in lists]],
                names=["dim", "qb", *names])


class Index:
    """The leaf blocks of all rows, with trees, ranges and sample for the tasks."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        rows = materialize(rows, "negatives-rows")
        n = rows.count()
        dim = rows.agg(F.max(F.size("q"))).first()[0] or 1
        size = min(SAMPLE_ROWS, max(256, SAMPLE_BYTES // (8 * dim)))
        sample = rows.orderBy(F.xxhash64("row"), "row").limit(size).toArrow()
        levels = 0 if n <= CELL_ROWS else min(LEVELS, max(1, round(math.log(n / CELL_ROWS, FANOUT))))
        self.samples = _samples(sample)
        trees = {d: grow(s["x"], levels) for d, s in self.samples.items()}
        shared = broadcast_value(spark, trees)
        fields = "row bigint, id bigint, label bigint, q array<bigint>, dim int, cell int"
        dealt = materialize(rows.mapInArrow(_deal(shared), fields), "negatives-cells")
        # As many rows as there are cells; each cell is cut into groups of bounded size.
        counts = dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"))
        groups = counts.select("dim", "cell", F.ceil(F.col("n") / GROUP_ROWS).alias("groups"))
        tasks = max(1, -(-n // GROUP_ROWS))
        blocks = dealt.join(F.broadcast(groups), ["dim", "cell"]).withColumn("group", F.pmod(F.xxhash64("row"), F.col("groups")))
        blocks = blocks.repartition(tasks, "dim", "cell", "group").sortWithinPartitions("dim", "cell", "group").select(*dealt.columns)
        self.blocks = materialize(blocks.mapInArrow(_pack(shared), BLOCKS), "negatives-blocks")
        self.rows, self.tasks = rows, tasks
        spans = self.blocks.select("dim", "cell", F.posexplode(F.arrays_zip("low", "high")))
        spans = spans.groupBy("dim", "cell", "pos").agg(F.min("col.low").alias("low"), F.max("col.high").alias("high")).toArrow()
        self.shared = broadcast_value(spark, {"trees": trees, "samples": self.samples, "ranges": _subtrees(trees, spans)})

    def search(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """(anchor, part, score, id, row): the k best rows in each window of ``anchors``.

        ``anchors`` has row, label, q and windows, an array of (part, low, high).
        """
        spark = anchors.sparkSession
        n = anchors.count()
        n_blocks = max(1, -(-n // QUERY_ROWS))
        packed = (
            anchors.withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
            .groupBy(F.size("q").alias("dim"), "qb").agg(F.collect_list(F.struct("row", "label", "q", "windows")).alias("anchors"))
            .select("dim", "qb", "anchors").mapInArrow(
                _pack_queries, "dim int, qb bigint, rows binary, labels binary, vectors binary, owner binary, part binary, low binary, high binary")
        )
        # Number blocks over all lengths, as they are told apart by it.
        packed = materialize(packed.withColumn("qb", F.xxhash64("dim", "qb")), "negatives-queries")
        names = ("rows", "labels", "vectors", "owner", "part", "low", "high")
        size = packed.agg(F.sum(sum(F.length(c) for c in names))).first()[0] or 0
        if size <= BROADCAST_BYTES:
            sent = spark.sparkContext.broadcast([r.asDict() for r in packed.collect()])
            found = self.blocks.mapInArrow(_searcher(self.shared, k, same, sent), FOUND)
        else:
            # Every query block meets every group of leaf blocks of its vector length.
            groups = max(1, self.tasks // 8)
            blocks = self.blocks.withColumn("group", F.pmod(F.xxhash64("rows"), F.lit(groups)))
            keys = packed.groupBy("dim").agg(F.collect_list("qb").alias("qbs"))
            blocks = blocks.join(keys, "dim").withColumn("qb", F.explode("qbs")).drop("qbs")
            asked = packed.select("dim", F.struct("qb", *names).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
            asked = asked.select("dim", F.col("q.qb").alias("qb"), F.col("group").cast("bigint").alias("group"), "q")
            met = blocks.join(asked, ["dim", "qb", "group"]).sortWithinPartitions("dim", "qb", "group").drop("qb", "group")
            found = met.mapInArrow(_searcher(self.shared, k, same), FOUND)
        order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), "id", "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _samples(sample: pa.Table) -> dict[int, dict]:
    flat, edges = vectors_in(sample["q"].combine_chunks())
    dims, out = np.diff(edges), {}
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        out[int(dim)] = {"x": flat[edges[at][:, None] + np.arange(dim)].reshape(len(at), dim),
                         **{name: sample[c].to_numpy()[at] for name, c in (("rows", "row"), ("ids", "id"), ("labels", "label"))}}
    return out


def _subtrees(trees: dict[int, dict], spans: pa.Table) -> dict[int, dict[int, dict]]:
    """Ranges of every child of every node, from those of its cells; subtrees without rows stay closed."""
    out: dict[int, dict[int, dict]] = {
        d: {n: {"least": np.full(len(p), np.inf), "most": np.full(len(p), -np.inf), "low": np.full((len(p), len(p)), np.inf),
                "high": np.full((len(p), len(p)), -np.inf)} for n, p in enumerate(t["points"])} for d, t in trees.items()}
    for dim, cell, pos, low, high in zip(*(spans[c].to_pylist() for c in ("dim", "cell", "pos", "low", "high"))):
        if dim not in trees:
            continue
        tree, begin = trees[dim], 1
        for node, child in tree["paths"][cell]:
            r, width = out[dim][node], len(tree["points"][node])
            if pos == 0:
                r["least"][child], r["most"][child] = min(r["least"][child], low), max(r["most"][child], high)
            elif begin <= pos < begin + width:
                i = pos - begin
                r["low"][child, i], r["high"][child, i] = min(r["low"][child, i], low), max(r["high"][child, i], high)
            begin += width
    for nodes in out.values():
        for r in nodes.values():
            empty = r["least"] > r["most"]
            r["least"][empty], r["most"][empty] = 0.0, 0.0
    return out


def mine(df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Negatives score from 30 to 90 percent of their positive.
    """
    index = Index(whole_rows(df, id_col, vec_col, label_col))
    anchors = index.rows.where(F.col("id") % every == 0)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("part"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")))
    near = materialize(index.search(anchors.withColumn("windows", whole), positives, True), "negatives-positives")
    asked = near.where("score >= 0").select(
        F.col("anchor").alias("row"), F.struct(F.col("rank").cast("long").alias("part"), F.expr("(3 * score + 9) div 10").alias("low"), F.expr("9 * score div 10").alias("high")).alias("w"))
    windows = asked.groupBy("row").agg(F.collect_list("w").alias("windows"))
    far = index.search(anchors.join(windows, "row"), negatives, False)
    pairs = near.select("anchor", F.col("rank").alias("part"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = pairs.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    found = far.select("anchor", "part", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(pairs, ["anchor", "part"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def noisy_label(id_col: str, label_col: str) -> Column:
    """Every seventh row's label moves on by one of ten."""
    label = F.col(label_col).cast("long")
    return F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label)


ORACLE = """WITH v AS (
  SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS a, a.id AS anchor_id, c.r AS c, c.id, a.label = c.label AS alike, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.q) = len(c.q) WHERE a.id % 100 = 0),
p AS (
  SELECT a, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a ORDER BY score DESC, id, c) AS part
  FROM s WHERE alike QUALIFY part <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.part ORDER BY s.score DESC, s.id, s.c)::INT AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.alike AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""


def op11_hard_negatives(spark, folder: str) -> DataFrame:
    """Hard negatives of the five nearest positives of every vector whose id is divisible by 100."""
    rows = table(spark, folder, "embeddings")
    return mine(rows.select("vec_id", "embedding", noisy_label("vec_id", "label").alias("label")))
