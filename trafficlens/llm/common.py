"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.session import materialize  # noqa: F401  (for the operators)

#: A word, as the contracts give it: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20
#: A null id stands after all others.
LAST = 2**63 - 1
HASH_BYTES = 256 << 10
ODD = 0x9E3779B97F4A7C15


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def broadcast_value(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object of this library. It travels with its classes, as workers cannot import them."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(shared: Broadcast) -> object:
    """The object behind :func:`broadcast_value`, in a task."""
    return pickle.loads(shared.value)


def mix64(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**n modulo 2**64."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
PIECE = 8


def _hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and beginnings of the words of some bytes that end in white space."""
    signs = np.frombuffer(text, np.uint8)
    space = SPACES[signs]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate([[0], edges])
    begin, end = edges[::2], edges[1::2]
    # Every word is cut into pieces of eight bytes. A piece and its number in the word are scrambled
    # before they are added up, so no two words meet by the form of their letters alone.
    pieces = (end - begin + PIECE - 1) // PIECE
    first = np.cumsum(pieces) - pieces
    number = np.arange(pieces.sum()) - np.repeat(first, pieces)
    at = np.repeat(begin, pieces) + PIECE * number
    left = np.minimum(np.repeat(end, pieces) - at, PIECE).astype(np.uint64)
    every = np.ndarray(len(text), "<u8", text + bytes(PIECE), strides=(1,))
    with np.errstate(over="ignore"):
        value = every[at] & (np.uint64(2**64 - 1) >> (np.uint64(8 * PIECE) - np.uint64(8) * left))
        value = mix64(value ^ mix64((number.astype(np.uint64) + np.uint64(1)) * np.uint64(ODD)))
        whole = np.add.reduceat(value, first) if len(first) else value
        return mix64(whole + (end - begin).astype(np.uint64) * np.uint64(ODD)), begin


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and the number of each text's words."""
    whole = b"\n".join(texts) + b"\n"
    hashes, begins, at = [], [], 0
    while at < len(whole):
        end = min(at + HASH_BYTES, len(whole))
        if end < len(whole):
            # Cut behind white space; a word longer than a piece stays whole.
            cut = max(whole.rfind(s, at, end) for s in (b"\n", b" "))
            end = cut + 1 if cut > at else min((c for c in (whole.find(s, end) for s in (b"\n", b" ")) if c >= 0), default=len(whole) - 1) + 1
        found, begin = _hashes(whole[at:end])
        hashes.append(found)
        begins.append(begin + at)
        at = end
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    counts = np.bincount(np.searchsorted(ends, np.concatenate(begins), side="right"), minlength=len(texts))
    return np.concatenate(hashes), counts.astype(np.int64)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if v is None else v for v in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each part holds about a megabyte of text, or one row."""
    for batch in batches:
        lengths = [0 if v is None else v for v in pa.compute.binary_length(batch.column(text)).to_pylist()]
        begun, total = 0, 0
        for i, n in enumerate(lengths):
            if total and total + n > SLICE_BYTES:
                yield batch.slice(begun, i - begun)
                begun, total = i, 0
            total += n
        if begun < batch.num_rows:
            yield batch.slice(begun)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, text): the id, null ids last, and a hash of id and text that tells rows of one id apart."""
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    return docs.select(doc.alias("doc"), F.xxhash64(doc, F.col(f"`{text_col}`")).alias("row"), F.col(f"`{text_col}`").alias("text"))


def bit_table(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """One bit per key modulo ``bits``; collected as at most bits/64 words."""
    slot = key.bitwiseAND(F.lit(bits - 1))
    words = keys.select(slot.alias("slot")).selectExpr("slot >> 6 AS w", "shiftleft(1L, cast(slot & 63 AS int)) AS b")
    rows = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(bits >> 6, np.int64)
    table[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return table.view(np.uint64)


def has_bit(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(len(table) * 64 - 1)
    return ((table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
