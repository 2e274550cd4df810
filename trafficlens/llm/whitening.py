"""Whitening by Chebyshev-filtered subspace iteration.

Every entry c becomes a whole number, x = floor(64 * c) + 1000000. The covariance V of all vectors is
never formed. Packed blocks of vectors stay in the shared folder, and one pass over them gives V Q for
a thin block Q: each task sums C'(C Q) over its rows C, centred exactly by (n * x - S) / n, and the
sums of many tasks are added in groups before the driver adds the groups.

An outer step runs the scaled three-term Chebyshev recurrence of ``DEGREE`` passes, which damps the
part of the spectrum between zero and the least Ritz value of the block and grows what lies above,
makes the block orthonormal by QR, and solves the small problem Q'VQ (Rayleigh-Ritz). The block has
``GUARD`` columns more than components are asked for. It ends when every wanted pair is certified: the
residual |V q - e q| is at most ``TOLERANCE`` times the greatest eigenvalue, which bounds the error of
e, and by the gaps to other eigenvalues that of q. Rounding sets a floor to residuals; when
``STALLED`` steps bring no progress the block is as good as doubles allow, and the largest residual is
reported in ``Whitening.residual``.

Rows whose vector is null or has a null or non-finite entry take no part, nor do entries whose whole
number has more than 40 bits, or empty vectors. Vectors must have one length: where there are several, the most frequent one
counts (of equally frequent ones the longest) and other rows take no part. Null ids, repeated ids and
repeated rows stay: each row counts and is returned. Components whose eigenvalue is below 1e-12 of the
greatest have no variance to scale to one and are left out; equal vectors, a single vector and an
empty table so give no rows. Equal eigenvalues have any orthonormal basis. The largest entry of each
component is positive. Input columns beyond id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import materialize, table

SCALE, SHIFT = 64, 1_000_000
#: Whole numbers of entries stay below this.
LARGEST = 2.0**40
BLOCK_BYTES = 2 << 20
COMPONENTS, GUARD, DEGREE = 32, 16, 10
TOLERANCE, STEPS, STALLED = 1e-13, 100, 3
LEAST_SHARE = 1e-12
#: Sums of up to this many tasks are added on the driver; those of more tasks in groups first.
DIRECT = 64
BLOCKS = "dim int, n int, ids binary, known binary, vectors binary"
#: Filtered columns may differ by this factor, so that the orthonormal block keeps its accuracy.
WIDEST = 1e10


@dataclass
class Whitening:
    """A fitted basis of the vectors in ``blocks``: ``basis`` and ``values`` have an entry per component.

    ``base`` and ``rest`` give the mean exactly, as base + rest / n. ``residual`` is the largest one, as a
    share of the greatest eigenvalue.
    """

    blocks: DataFrame
    n: int
    base: np.ndarray
    rest: np.ndarray
    basis: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int


def whole_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, y) of valid rows; y is x without the shift."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < LARGEST))
    rows = rows.where(F.coalesce(fine, F.lit(False)) & (F.size("v") > 0))
    return rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("y"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows of one length; a mark tells null ids."""
    for batch in batches:
        ids, known = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        lengths = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dim)
            y = batch.column(1).take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
            step = max(1, BLOCK_BYTES // (8 * dim))
            for i in range(0, len(at), step):
                part, here = y[i : i + step], at[i : i + step]
                kind = np.int32 if np.abs(part).max() < 2**31 else np.int64
                held = [ids[here].astype(np.int64), known[here].astype(np.uint8), part.astype(kind)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([len(part)], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in held]],
                    names=["dim", "n", "ids", "known", "vectors"])


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, marks of known ids and whole numbers of each block."""
    for i in range(batch.num_rows):
        dim, n, ids, known, held = (batch.column(j)[i].as_py() for j in range(5))
        kind = np.int32 if len(held) == 4 * n * dim else np.int64
        yield np.frombuffer(ids, np.int64), np.frombuffer(known, np.uint8).astype(bool), np.frombuffer(held, kind).reshape(n, dim).astype(np.int64)


def added(blocks: DataFrame, make: Callable, shape: tuple[int, ...], kind: type = np.float64) -> np.ndarray:
    """The sum of ``make(whole numbers)`` over all blocks. Tasks are added in a fixed order."""
    tasks = blocks.rdd.getNumPartitions()
    groups = 1 if tasks <= DIRECT else int(np.ceil(np.sqrt(tasks)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, some = np.zeros(shape, kind), False
        for batch in batches:
            for _, _, y in _opened(batch):
                total += make(y)
                some = True
        if some:
            k = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k % groups], pa.int32()), pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["g", "k", "m"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for g, m in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                sums[g] = sums.get(g, 0) + np.frombuffer(m, kind)
        for g, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([g], pa.int32()), pa.array([m.tobytes()], pa.binary())], names=["g", "k", "m"])

    parts = blocks.mapInArrow(each, "g int, k int, m binary")
    if groups > 1:
        parts = parts.repartition(groups, "g").sortWithinPartitions("g", "k").mapInArrow(together, "g int, k int, m binary")
    total = np.zeros(shape, kind)
    for r in sorted(parts.collect(), key=lambda r: r["k"]):
        total += np.frombuffer(r["m"], kind).reshape(shape)
    return total


def centred(y: np.ndarray, base: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    """(n * x - S) / n, with one rounding per entry."""
    return (y - base) - rest / n


def deviations(y: np.ndarray, base: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """Exact sums of (n * x - S)**2; None beyond 64 bits."""
    u = y - base
    # By n^2 u^2 - 2 n u rest + rest^2; the first two sums fit 64 bits for all but huge entries.
    greatest = float(np.abs(u).max())
    if max(greatest, float(rest.max())) * (greatest + 1) * u.shape[1] > 2.0**62:
        u, rest = u.astype(object), rest.astype(object)
    last = sum(int(r) ** 2 for r in rest)
    found = (n * n * int(a) - 2 * n * int(b) + last for a, b in zip((u * u).sum(axis=1), (u * rest).sum(axis=1)))
    return [d if d < 2**63 else None for d in found]


def _solve(times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, product: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Greatest eigenvalues, vectors as columns, and the largest residual as a share of the greatest eigenvalue.

    ``times`` is one pass over the data; ``product`` is that of the orthonormal ``block``.
    """
    best, since, steps = np.inf, 0, 0
    while True:
        small = block.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        top = max(values[0], 0.0)
        count = min(wanted, int((values > LEAST_SHARE * top).sum())) if top > 0 else 0
        if not count:
            return values[:0], block[:, :0], 0.0
        residual = float(np.linalg.norm(product[:, :count] - block[:, :count] * values[:count], axis=0).max() / top)
        since = 0 if residual < best / 2 else since + 1
        best = min(best, residual)
        steps += 1
        if residual <= TOLERANCE or block.shape[0] == block.shape[1] or since >= STALLED or steps >= STEPS:
            return values[:count], block[:, :count], residual
        cut = max(values[-1], 1e-8 * top)
        centre = half = cut / 2
        reach = (top - centre) / half
        degree = int(np.clip(np.arccosh(WIDEST) / np.arccosh(max(reach, 1.01)), 1, DEGREE))
        ratio = first = half / (top - centre)
        before, now = block, (product - centre * block) * (first / half)
        for _ in range(degree - 1):
            following = 1 / (2 / first - ratio)
            now, before = 2 * (times(now) - centre * now) * (following / half) - ratio * following * before, now
            ratio = following
        block = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
        product = times(block)


def fit(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 11) -> Whitening | None:
    """The basis of all vectors; None where there are none."""
    blocks = materialize(whole_vectors(df, id_col, vec_col).mapInArrow(_pack, BLOCKS), "whitening")
    lengths = blocks.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if lengths is None:
        return None
    dim, n = lengths["dim"], lengths["n"]
    blocks = blocks.where(F.col("dim") == dim)
    # Sums of high and low bits, which stay far from 64 bits.
    bits = added(blocks, lambda y: np.stack([(y >> 20).sum(axis=0), (y & 0xFFFFF).sum(axis=0)]), (2, dim), np.int64)
    sums = [(int(h) << 20) + int(low) for h, low in bits.T]
    base, rest = np.array([s // n for s in sums]), np.array([s % n for s in sums])
    passes = [0]

    def times(q: np.ndarray) -> np.ndarray:
        def make(y: np.ndarray) -> np.ndarray:
            c = centred(y, base, rest, n)
            return c.T @ (c @ q)

        passes[0] += 1
        return added(blocks, make, q.shape) / n

    def spread(y: np.ndarray) -> np.ndarray:
        return (centred(y, base, rest, n) ** 2).sum(axis=0)

    trace = float(added(blocks, spread, (dim,)).sum() / n)
    width = min(dim, components + GUARD)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, width)))[0]
    values, basis, residual = _solve(times, block, times(block), min(components, dim))
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])] < 0, -1.0, 1.0)
    k = len(values)

    def moments(y: np.ndarray) -> np.ndarray:
        w = centred(y, base, rest, n) @ basis / np.sqrt(values)
        return np.concatenate([w.sum(axis=0)[None, :], w.T @ w])

    error = 0.0
    if k:
        m = added(blocks, moments, (k + 1, k)) / n
        error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max())
    return Whitening(blocks, n, base, rest, basis, values, trace, error, residual, passes[0])


def whiten(fitted: Whitening) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    n, base, rest, basis = fitted.n, fitted.base, fitted.rest, fitted.basis
    scaled, error = basis / np.sqrt(fitted.values), fitted.identity_error
    explained, k = fitted.values / (fitted.trace or 1.0), len(fitted.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, known, y in _opened(batch):
                w = centred(y, base, rest, n) @ scaled
                far = np.repeat(np.array(deviations(y, base, rest, n), object), k)
                rows = len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(ids, k), pa.int64(), mask=np.repeat(~known, k)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)), pa.array(far.tolist(), pa.int64()), pa.array(w.ravel()),
                    pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fitted.blocks.mapInArrow(project, "id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op13_whitening(spark, folder: str) -> DataFrame:
    """Whitened coordinates of every embedding along up to 32 components."""
    fitted = fit(table(spark, folder, "embeddings"))
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return whiten(fitted).withColumnRenamed("id", "vec_id")
