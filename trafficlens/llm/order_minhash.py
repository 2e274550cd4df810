"""Near duplicates by order MinHash, verified by banded alignment.

A text becomes the sequence of its five-word shingles, each labelled with the number of its
occurrence, so that no label repeats. A sketch takes the two shingles of least hash and keeps their
order in the text; texts with few edits agree on it, texts with the same words in another order do
not. 24 bands of 3 sketches are keys of candidate buckets (a pair of similarity 0.8 misses all bands
with probability under 0.001).

Similarity of two texts: aligned / (n_a + n_b - aligned), where aligned is the longest common
subsequence of labelled shingles. As labels do not repeat, it is the longest increasing run of
matched positions, and a pair that can reach the threshold lies in a band around the diagonal.

* Texts with the same words are one node, the smallest (id, row hash) of them; they are joined by a
  128-bit hash and never paired.
* In a bucket all nodes are compared with its hub: the node that shares most buckets with others.
  Links are merged to components. Then, in buckets that still hold several components, each node
  outside the largest one is compared with all nodes of other components. So every pair of a bucket
  is compared or connected already, without listing the pairs of a large group. Such a comparison is
  left out where 1024 parity bits of the two shingle sets differ in more places than the sets may
  (each shingle that only one of them holds flips one bit): no similar pair fails that test.
* Components: least labels along the links with pointer jumping, each round written to the shared
  folder.

Texts of fewer than five words have one shingle of all their words. Null and empty texts are alone
in their class. Rows that share an id are separate nodes with the same id; equal rows are one.
Null ids count as the last. Extra columns take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import LAST, bit_table, documents, has_bit, keyed_texts, materialize, mix64, slices, texts_of, word_hashes

SHINGLE = 5
BANDS = 24
ROWS = 3
TAKEN = 2
SIMILARITY = 0.8
ODD = np.uint64(0x9E3779B97F4A7C15)
COLUMNS = 4096
PARITY_BITS = 1024
BITS_MIN, BITS_MAX = 1 << 20, 1 << 27


def labelled_shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of shingles with the number of their occurrence; none repeats."""
    n = len(words)
    if not n:
        return words
    with np.errstate(over="ignore"):
        width = min(size, n)
        value = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            value = value * ODD + words[j : n - width + 1 + j]
        value = mix64(value + np.uint64(width))
        order = np.argsort(value, kind="stable")
        ranked = value[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))
        label = np.empty(len(ranked), np.uint64)
        label[order] = (np.arange(len(ranked)) - first).astype(np.uint64)
        return mix64(value + label * ODD)


def words_by_text(texts: list[bytes]) -> list[np.ndarray]:
    words, counts = word_hashes(texts)
    return np.split(words, np.cumsum(counts)[:-1])


def _factors(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def bands_of(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key per band: the least shingles of its sketches, in text order."""
    factors, taken = _factors(bands * rows), min(TAKEN, len(shingles))
    with np.errstate(over="ignore"):
        values, places = [], []
        for begin in range(0, len(shingles), COLUMNS):
            part = factors[:, None] * shingles[None, begin : begin + COLUMNS]
            line = np.arange(len(factors))
            for _ in range(min(taken, part.shape[1])):
                at = part.argmin(axis=1)
                values.append(part[line, at])
                places.append(at + begin)
                part[line, at] = np.uint64(2**64 - 1)
        values, places = np.stack(values, axis=1), np.stack(places, axis=1)
        least = np.argsort(values, axis=1, kind="stable")[:, :taken]
        in_order = np.sort(np.take_along_axis(places, least, axis=1), axis=1)
        found = shingles[in_order].reshape(bands, rows * taken)
        key = mix64(np.arange(bands, dtype=np.uint64) + ODD)
        for j in range(found.shape[1]):
            key = mix64(key * ODD + found[:, j])
    return key


def parity(shingles: np.ndarray) -> np.ndarray:
    """One bit per hash class: whether the number of shingles in it is odd."""
    odd = np.bincount((shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketcher(size: int, bands: int, rows: int):
    schema = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int32()), ("bands", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in slices(batches):
            out = {name: [] for name in schema.names}
            texts = texts_of(part.column("text"))
            for words, doc, row in zip(words_by_text(texts), part.column("doc").to_pylist(), part.column("row").to_pylist()):
                # The words' hashes stand for the words: equal texts are those with equal sequences.
                whole = xxhash.xxh128_intdigest(words.tobytes()) if len(words) else None
                shingles = labelled_shingles(words, size)
                out["doc"].append(doc)
                out["row"].append(row)
                out["h1"].append(None if whole is None else (whole >> 64) - (1 << 63))
                out["h2"].append(None if whole is None else (whole & (2**64 - 1)) - (1 << 63))
                out["n"].append(len(shingles))
                out["bands"].append(bands_of(shingles, bands, rows).view(np.int64) if len(words) else None)
                out["parity"].append(parity(shingles) if len(words) else None)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return scan


def _sequences(size: int, shared):
    """Labelled shingles, 32 bits each, of the texts that occur in pairs."""
    schema = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("shingles", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = part.column("row").to_numpy(zero_copy_only=False)
            at = np.flatnonzero(has_bit(shared.value, rows.astype(np.int64).view(np.uint64)))
            if not len(at):
                continue
            chosen = part.take(pa.array(at))
            found = [labelled_shingles(w, size).astype(np.uint32).tobytes() for w in words_by_text(texts_of(chosen.column("text")))]
            yield pa.RecordBatch.from_arrays([chosen.column("doc"), chosen.column("row"), pa.array(found, pa.binary())], schema=schema)

    return scan


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> int:
    """Longest common subsequence of sequences without repeats, inside the band the threshold allows."""
    least = int(np.ceil(similarity / (1 + similarity) * (len(a) + len(b)) - 1e-9))
    if min(len(a), len(b)) < least:
        return 0
    if np.array_equal(a, b):
        return len(a)
    _, in_a, in_b = np.intersect1d(a, b, return_indices=True)
    band = len(a) + len(b) - 2 * least
    near = np.abs(in_a - in_b) <= band
    in_a, in_b = in_a[near], in_b[near]
    if len(in_a) < least:
        return 0
    tails: list[int] = []
    for j in in_b[np.argsort(in_a)].tolist():
        at = bisect_left(tails, j)
        if at == len(tails):
            tails.append(j)
        else:
            tails[at] = j
    return len(tails)


def similarity_of(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Similarity, or 0 where the band shows that it stays under the threshold."""
    common = aligned(a, b, similarity)
    return common / (len(a) + len(b) - common) if common else 0.0


def _verifier(similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            keep = [similarity_of(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), similarity) >= similarity - 1e-12 for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


NODE = "struct<doc:bigint,row:bigint>"


def _verified(pairs: DataFrame, keyed: DataFrame, size: int, similarity: float, tag: str) -> DataFrame:
    """The pairs (a, b) that are similar. Only texts of pairs are hashed and shuffled."""
    spark = pairs.sparkSession
    ends = pairs.select(F.col("a.row").alias("row")).unionByName(pairs.select(F.col("b.row").alias("row")))
    bits = BITS_MIN
    while bits < BITS_MAX and bits < 32 * pairs.count():
        bits *= 2
    shared = spark.sparkContext.broadcast(bit_table(ends, F.col("row"), bits))
    texts = keyed.mapInArrow(_sequences(size, shared), "doc long, row long, shingles binary").dropDuplicates(["doc", "row"])
    texts = materialize(texts.select(F.struct("doc", "row").alias("node"), "shingles"), f"near-texts-{tag}")
    met = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    )
    return met.select("a", "b", "sa", "sb").mapInArrow(_verifier(similarity), f"a {NODE}, b {NODE}")


def components(links: DataFrame, tag: str) -> DataFrame:
    """(node, label): the least node that each node of a link is connected with."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, f"near-links-{tag}")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), f"near-label-{tag}")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("around"))
        step = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "around").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        step = materialize(step, f"near-label-{tag}")
        labels = step.select("node", "label")
        if step.where("label != old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    bands: int = BANDS, rows: int = ROWS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc, row, class): every row with the least (id, row hash) of its class; ``row`` is xxhash64 of id and text."""
    tag = uuid.uuid4().hex[:8]
    keyed = keyed_texts(docs, id_col, text_col)
    sketched = materialize(keyed.select("doc", "row", "text").mapInArrow(
        _sketcher(size, bands, rows), "doc long, row long, h1 long, h2 long, n int, bands array<long>, parity array<long>"), f"near-sketch-{tag}")
    full = sketched.where("h1 IS NOT NULL")
    nodes = full.groupBy("h1", "h2").agg(F.min(F.struct("doc", "row")).alias("node"))
    nodes = materialize(nodes, f"near-nodes-{tag}")
    first = full.select(F.struct("doc", "row").alias("node"), "n", "bands").join(nodes.select("node"), "node").dropDuplicates(["node"])
    entries = first.select("node", "n", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    entries = materialize(entries.join(sizes, "key"), f"near-buckets-{tag}")
    # The hub of a bucket: the node with most company in all its buckets, the least of these.
    weight = entries.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = entries.join(weight, "node")
    hubs = weighed.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), "node", "n")).alias("hub"))
    shared_enough = F.least("n", "m") >= similarity * F.greatest("n", "m") - 1e-9
    stars = entries.join(hubs, "key").select(F.col("hub.node").alias("hub"), F.col("hub.n").alias("m"), "node", "n")
    stars = stars.where((F.col("hub") != F.col("node")) & shared_enough)
    pairs = materialize(stars.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct(), f"near-pairs-{tag}")
    links = materialize(_verified(pairs, keyed, size, similarity, tag), f"near-found-{tag}")
    labels = components(links, tag)
    # Buckets that still hold several components: what lies outside the largest meets the rest.
    owned = entries.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))
    parts = owned.groupBy("key", "label").agg(F.count("*").alias("size"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    sets = full.select(F.struct("doc", "row").alias("node"), "parity").dropDuplicates(["node"])
    mixed = owned.join(mixed.select("key", F.col("top.label").alias("top")), "key").join(sets, "node")
    mixed = materialize(mixed, f"near-mixed-{tag}")
    outside = mixed.where("label != top").select("key", F.col("node").alias("out"), F.col("n").alias("m"), F.col("label").alias("out_label"), F.col("parity").alias("out_parity"))
    differing = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("out_parity")[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    may_differ = (F.col("n") + F.col("m")) * ((1 - similarity) / (1 + similarity)) + 1e-9
    rest = outside.join(mixed, "key").where((F.col("label") != F.col("out_label")) & shared_enough & (differing <= may_differ))
    rest = rest.select(F.least("out", "node").alias("a"), F.greatest("out", "node").alias("b")).distinct()
    rest = materialize(rest.join(pairs, ["a", "b"], "left_anti"), f"near-rest-{tag}")
    if not rest.isEmpty():
        more = materialize(_verified(rest, keyed, size, similarity, tag), f"near-found-{tag}")
        if not more.isEmpty():
            labels = components(links.unionByName(more), tag)
    classes = nodes.join(labels, "node", "left").select("h1", "h2", F.coalesce("label", "node").alias("class"))
    classed = sketched.join(classes, ["h1", "h2"], "left")
    return classed.select("doc", "row", F.coalesce("class", F.struct("doc", "row")).alias("class"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents without all but the first (by id) of each class of near duplicates."""
    kept = near_duplicates(docs, id_col, text_col, **settings).where("class.doc = doc AND class.row = row").select("doc", "row").distinct()
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    rows = docs.select(doc.alias("_doc"), F.xxhash64(doc, F.col(f"`{text_col}`")).alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"))
    joined = rows.join(kept.withColumnsRenamed({"doc": "_doc", "row": "_row"}), ["_doc", "_row"])
    return joined.dropDuplicates(["_doc", "_row"]).select("_all.*")


def op9_order_minhash(spark, folder: str) -> DataFrame:
    """Every document with the id of its class: the least id of its near duplicates."""
    found = near_duplicates(documents(spark, folder))
    # Null ids travel as the greatest number.
    return found.select(*[F.when(c != LAST, c).alias(n) for c, n in ((F.col("doc"), "doc_id"), (F.col("class.doc"), "class_id"))])
