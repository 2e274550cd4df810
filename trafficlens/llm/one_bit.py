"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Vectors are taken relative to the mean of all vectors, rotated by a random orthogonal matrix and
reduced to the signs of their entries, packed into 64-bit words, with two scalars each: the length
and the correction <code, vector>. Rotated queries are cut into 8 bit planes; counting common bits
gives <code, query>, and dividing by the correction an unbiased estimate of the inner product. Its
error is at most ``eps`` standard bounds (plus the exactly known error of the bit planes), so a
vector is ranked again by its true distance only if its lower bound beats the k-th distance so far.

All vectors are searched, in blocks: packed blocks of vectors meet blocks of queries, and each task
keeps k rows per query. The k best of all tasks are chosen by a window over (query). The error
bound holds with high probability, so the result may miss a neighbour; tests measure recall.

Null vectors, vectors with null or non-finite entries, and zero vectors take no part. Vectors of
different length are not compared. A query id that occurs on several rows is answered once, for the
smallest of its vectors. Repeated candidates count each. Ties go to the smaller id; null ids take no
part. Input columns beyond id and vector are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.llm.common import table

BLOCK_ROWS = 2048
QUERY_BLOCK = 1024
PLANES = 8
EPS = 3.0
#: Query blocks are broadcast up to this many bytes; beyond, they are joined by block number.
BROADCAST_BYTES = 64 << 20
BLOCKS = "dim int, ids binary, vectors binary"
PARTIAL = "query_id bigint, vec_id bigint, score double"


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors of one length."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        vectors = batch.column(1)
        lengths = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
        out = {"dim": [], "ids": [], "vectors": []}
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
            for i in range(0, len(at), BLOCK_ROWS):
                out["dim"].append(int(dim))
                out["ids"].append(ids[at[i : i + BLOCK_ROWS]].astype(np.int64).tobytes())
                out["vectors"].append(np.ascontiguousarray(flat[i : i + BLOCK_ROWS], dtype=np.float64).tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())]))


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    n, dim = bits.shape
    padded = np.zeros((n, -(-dim // 64) * 64), dtype=np.uint8)
    padded[:, :dim] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """One-bit codes of a block of vectors."""

    def __init__(self, vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray):
        dim = vectors.shape[1]
        away = vectors - mean
        self.length = np.linalg.norm(away, axis=1)
        unit = away / np.where(self.length > 0, self.length, 1.0)[:, None]
        turned = unit @ turn
        self.bits = _words(turned > 0)
        # <code, vector>; at least a little above zero for vectors equal to the mean.
        self.fit = np.maximum(np.abs(turned).sum(axis=1) / np.sqrt(dim), 1e-9)

    def estimate(self, query: "TurnedQuery", eps: float) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of unit vectors and query, and the bound of their errors."""
        common = np.zeros(len(self.fit))
        for b in range(PLANES):
            common += np.bitwise_count(self.bits & query.planes[b]).sum(axis=1) * float(1 << b)
        set_bits = np.bitwise_count(self.bits).sum(axis=1)
        ones = query.low * set_bits + query.step * common
        product = (2 * ones - query.total) / np.sqrt(query.dim)
        fit = np.minimum(self.fit, 1.0)
        spread = np.sqrt(1 - fit**2) / fit * eps / np.sqrt(max(query.dim - 1, 1))
        return product / self.fit, spread + query.error / self.fit


class TurnedQuery:
    def __init__(self, vector: np.ndarray, mean: np.ndarray, turn: np.ndarray):
        away = vector - mean
        self.dim = len(vector)
        self.length = float(np.linalg.norm(away))
        unit = (away / (self.length or 1.0)) @ turn
        self.low = float(unit.min())
        self.step = float(unit.max() - self.low) / (2**PLANES - 1) or 1.0
        steps = np.rint((unit - self.low) / self.step).astype(np.int64)
        rebuilt = self.low + self.step * steps
        self.total = float(rebuilt.sum())
        self.error = float(np.linalg.norm(unit - rebuilt))
        self.planes = [_words(((steps >> b) & 1)[None, :])[0] for b in range(PLANES)]


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed in the order of the entries."""
    total = np.zeros(len(vectors))
    for j in range(vectors.shape[1]):
        gap = vectors[:, j] - query[j]
        total += gap * gap
    return np.sqrt(total)


def _searcher(means: dict[int, list[float]], k: int, eps: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        turned: dict[tuple, list] = {}
        best: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                mean = np.array(means[dim])
                turn = turns[dim] if dim in turns else turns.setdefault(dim, rotation(dim))
                ids = np.frombuffer(row["ids"], np.int64)
                vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), dim)
                codes = Codes(vectors, mean, turn)
                key = (dim, row["qb"])
                if key not in turned:
                    q_ids = np.frombuffer(row["q_ids"], np.int64)
                    q_vectors = np.frombuffer(row["q_vectors"], np.float64).reshape(len(q_ids), dim)
                    turned[key] = [(int(i), v, TurnedQuery(v, mean, turn)) for i, v in zip(q_ids, q_vectors)]
                for query_id, vector, query in turned[key]:
                    have = best.get((dim, query_id))
                    product, error = codes.estimate(query, eps)
                    scale = 2 * codes.length * query.length
                    middle = codes.length**2 + query.length**2 - scale * product
                    low, high = middle - scale * error, middle + scale * error
                    open_ = ids != query_id
                    limit = have[0][-1] ** 2 if have is not None and len(have[0]) == k else np.inf
                    if open_.sum() > k:
                        limit = min(limit, np.partition(high[open_], k - 1)[k - 1])
                    at = np.flatnonzero(open_ & (low <= limit * (1 + 1e-9) + 1e-12))
                    if not len(at):
                        continue
                    d, found = distances(vectors[at], vector), ids[at]
                    if have is not None:
                        d, found = np.concatenate([have[0], d]), np.concatenate([have[1], found])
                    order = np.lexsort((found, d))[:k]
                    best[dim, query_id] = (d[order], found[order])
        rows = [(q, int(i), float(d)) for (_, q), (ds, found) in best.items() for d, i in zip(ds, found)]
        for i in range(0, len(rows), 50_000):
            part = list(zip(*rows[i : i + 50_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0], pa.int64()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.float64())],
                names=["query_id", "vec_id", "score"])

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding", eps: float = EPS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of ``vectors`` to each row of ``queries``.

    Rows that share the query's id are no candidates for it.
    """
    rows = valid_vectors(vectors, id_col, vec_col)
    asked = valid_vectors(queries, id_col, vec_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    # One row per vector length; the mean vector has as many numbers as the vectors.
    sums = rows.select(F.size("v").alias("dim"), F.posexplode("v")).groupBy("dim", "pos").agg(F.avg("col").alias("m"))
    means: dict[int, list[float]] = {}
    for r in sums.orderBy("dim", "pos").collect():
        means.setdefault(r["dim"], []).append(r["m"])
    size = asked.agg(F.count("*").alias("n"), F.sum(F.size("v") * 8 + 8).alias("bytes")).first()
    n_blocks = max(1, -(-size["n"] // QUERY_BLOCK))
    # Blocks of about QUERY_BLOCK queries, each gathered in one row.
    blocks = (
        asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
        .groupBy(F.size("v").alias("dim"), "qb").agg(F.collect_list(F.struct("vec_id", "v")).alias("q"))
        .select("dim", "qb", "q").mapInArrow(_pack_queries, "dim int, qb int, q_ids binary, q_vectors binary")
    )
    if (size["bytes"] or 0) <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    packed = rows.select("vec_id", "v").mapInArrow(_pack, BLOCKS).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    met = packed.join(blocks, ["dim", "qb"])
    partial = met.select("dim", "qb", "ids", "vectors", "q_ids", "q_vectors").mapInArrow(_searcher(means, k, eps), PARTIAL)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"dim": [], "qb": [], "q_ids": [], "q_vectors": []}
        for row in batch.to_pylist():
            out["dim"].append(row["dim"])
            out["qb"].append(row["qb"])
            out["q_ids"].append(np.array([q["vec_id"] for q in row["q"]], np.int64).tobytes())
            out["q_vectors"].append(np.array([q["v"] for q in row["q"]], np.float64).tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("dim", pa.int32()), ("qb", pa.int32()), ("q_ids", pa.binary()), ("q_vectors", pa.binary())]))


ORACLE = """WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
         lambda a, b: a + b)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


def op8_one_bit_neighbours(spark, folder: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    rows = table(spark, folder, "embeddings")
    return nearest(rows, rows.where("vec_id % 100 = 0"))
