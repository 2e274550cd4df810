"""Removal of passages that occur earlier, by compacting a de Bruijn graph of the words.

Windows of 20 words are the edges of a de Bruijn graph over 19-word nodes. Its unbranched paths are
never followed edge by edge: each window has an anchor, its 8-word piece of least hash, and
neighbouring windows with the same anchor form one compacted path (about one row per 7 words).
Equal windows have equal anchors, so

1. paths with equal words are merged to their earliest source coordinate, and beside them the least
   and greatest path of each anchor (one shuffle; both are merged in the tasks before, so neither a
   path nor an anchor that a third of all documents hold gathers in one task);
2. an anchor with one path is unbranched: later copies of it repeat all their windows;
3. an anchor with several paths branches: only there the single windows are compared, each with its
   earliest source coordinate among the anchor's distinct paths. Windows of one path never equal each
   other, so an anchor that is taken for a branching one by mistake costs space only.

Coordinates (document, start) of the marked windows are joined back to the texts, where the words
under them are removed. A path is known by two 64-bit hashes, a window by its anchor's and its own.

Before the second shuffle each task drops paths that cannot have a partner, by a bit table of at
most ``BITS_MAX`` bits. False hits only cost space: the join behind it is exact. Beyond about
2**28 repeated paths the table fills and all paths are shuffled.

Null and empty texts have no words. Texts of fewer than 20 words stay whole. Rows with a null id
count as last in order, and as one document. Rows that share an id count as one document too: a
window at the same start in two of them repeats none of them. Repeated rows get the same result
each. Extra columns are kept by ``remove_repeats`` and take no part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm.common import LAST, bit_table, documents, has_bit, keyed_texts, materialize, mix64, powers, slices, texts_of, word_hashes

WINDOW = 20
ANCHOR = 8
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
FLUSH_ROWS = 400_000
BITS_MIN, BITS_MAX, BITS_PER_PATH = 1 << 20, 1 << 28, 16


class Paths:
    """The compacted paths of some texts: runs of windows with one anchor."""

    def __init__(self, texts: list[bytes], window: int = WINDOW, anchor: int = ANCHOR):
        words, counts = word_hashes(texts)
        n, self.window = len(words), window
        self.doc = np.empty(0, np.int64)
        if n < window or counts.max() < window:
            return
        with np.errstate(over="ignore"):
            self.down = powers(int(INVERSE), n)
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers(int(MULTIPLIER), n)[:n])])
        pieces = mix64(self._hash(np.arange(n - anchor + 1), anchor))
        least, at = pieces, np.arange(len(pieces))
        width, size = 1, window - anchor + 1
        while width < size:
            step = min(width, size - width)
            left = least[:-step] <= least[step:]
            least, at = np.where(left, least[:-step], least[step:]), np.where(left, at[:-step], at[step:])
            width += step
        ends = np.cumsum(counts)
        left_over = np.repeat(ends, counts)[: n - window + 1] - np.arange(n - window + 1)
        starts = np.flatnonzero(left_over >= window)
        first = np.flatnonzero(np.concatenate([[True], at[starts][1:] != at[starts][:-1]]))
        self.begin = starts[first]
        self.n = np.diff(np.concatenate([first, [len(starts)]]))
        with np.errstate(over="ignore"):
            self.anchor = mix64(pieces[at[self.begin]] + MULTIPLIER)
            length = (self.n + window - 1).astype(np.uint64)
            self.span = mix64(self._hash(self.begin, self.n + window - 1) + length * INVERSE)
        self.doc = np.searchsorted(ends, self.begin, side="right")
        self.start = self.begin - (ends - counts)[self.doc]

    def _hash(self, begin: np.ndarray, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[begin + length] - self.sums[begin]) * self.down[begin]

    def windows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and hashes of the windows of some paths, one after the other."""
        n = self.n[rows]
        offsets = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.begin[rows] - offsets[:-1], n) + np.arange(offsets[-1])
        return offsets, mix64(self._hash(at, self.window)).view(np.int64)


def _first_paths(window: int, anchor: int):
    """Per task, each path once with its earliest coordinate and its number, and each anchor once,
    without a ``span``, with its least and greatest path."""
    schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("n", pa.int64()),
                        ("least", pa.int64()), ("greatest", pa.int64())])

    def batch(size: int, **columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def merged(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        a, s, d, p = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((p, d, s, a))
        a, s, d, p = a[order], s[order], d[order], p[order]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1])]))
        n = np.diff(np.concatenate([new, [len(a)]]))
        a, s = a[new], s[new]
        yield batch(len(a), anchor=a, span=s, doc=d[new], start=p[new].astype(np.int32), n=n)
        edge = np.flatnonzero(a[1:] != a[:-1])
        first, last = np.concatenate([[0], edge + 1]), np.concatenate([edge, [len(a) - 1]])
        yield batch(len(first), anchor=a[first], least=s[first], greatest=s[last])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in slices(batches):
            paths = Paths(texts_of(part.column("text")), window, anchor)
            if len(paths.doc):
                ids = part.column("doc").to_numpy(zero_copy_only=False)
                parts.append((paths.anchor.view(np.int64), paths.span.view(np.int64), ids[paths.doc], paths.start))
                held += len(paths.doc)
            if held > FLUSH_ROWS:
                yield from merged(parts)
                parts, held = [], 0
        if parts:
            yield from merged(parts)

    return scan


PATHS = "anchor long, span long, doc long, start int, n long, least long, greatest long"
OCCURRENCES = "anchor long, span long, doc long, row long, start int, n int, windows array<long>"


def _occurrences(window: int, anchor: int, shared):
    """Paths that may have a partner; with their windows where the anchor may branch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path_bits, branch_bits = shared.value
        for part in slices(batches):
            paths = Paths(texts_of(part.column("text")), window, anchor)
            if not len(paths.doc):
                continue
            branches = has_bit(branch_bits, paths.anchor)
            keep = np.flatnonzero(branches | has_bit(path_bits, paths.anchor ^ paths.span))
            if not len(keep):
                continue
            branching = branches[keep]
            offsets, values = paths.windows(keep[branching])
            lengths = np.zeros(len(keep), np.int64)
            lengths[branching] = np.diff(offsets)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            doc = paths.doc[keep]
            yield pa.RecordBatch.from_arrays([
                pa.array(paths.anchor[keep].view(np.int64)), pa.array(paths.span[keep].view(np.int64)),
                pa.array(part.column("doc").to_numpy(zero_copy_only=False)[doc]),
                pa.array(part.column("row").to_numpy(zero_copy_only=False)[doc]),
                pa.array(paths.start[keep].astype(np.int32)), pa.array(paths.n[keep].astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=pa.array(~branching)),
            ], names=["anchor", "span", "doc", "row", "start", "n", "windows"])

    return scan


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc, row, start, n): n windows from ``start`` on that occur earlier. ``row`` tells rows of one id apart."""
    if not 0 < anchor <= window:
        raise ValueError(f"an anchor of {anchor} words does not fit into a window of {window}")
    spark, keyed = docs.sparkSession, keyed_texts(docs, id_col, text_col)
    tag = uuid.uuid4().hex[:8]
    local = keyed.select("doc", "text").mapInArrow(_first_paths(window, anchor), PATHS)
    merged = local.repartition("anchor", "span").groupBy("anchor", "span").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    # Paths that occur again, and the anchors that branch.
    merged = merged.where("n > 1 OR least < greatest").select(
        "anchor", "span", F.col("first.doc").alias("first_doc"), F.col("first.start").alias("first_start"))
    merged = materialize(merged, f"repeat-paths-{tag}")
    known, branching = merged.where("span IS NOT NULL"), merged.where("span IS NULL")

    def table(keys: DataFrame, key: Column) -> np.ndarray:
        bits, wanted = BITS_MIN, BITS_PER_PATH * keys.count()
        while bits < BITS_MAX and bits < wanted:
            bits *= 2
        return bit_table(keys, key, bits)

    shared = spark.sparkContext.broadcast((table(known, F.col("anchor").bitwiseXOR(F.col("span"))), table(branching, F.col("anchor"))))
    # A path at a branching anchor that is not among the known ones occurs once and is its own first.
    found = keyed.mapInArrow(_occurrences(window, anchor, shared), OCCURRENCES).join(known, ["anchor", "span"], "left")
    is_first = F.col("first_doc").isNull() | ((F.col("doc") == F.col("first_doc")) & (F.col("start") == F.col("first_start")))
    found = found.select("anchor", "doc", "row", "start", "n", is_first.alias("is_first"), F.when(is_first, F.col("windows")).alias("windows"))
    found = materialize(found.where("NOT is_first OR windows IS NOT NULL"), f"repeat-found-{tag}")
    single = found.where("is_first").select("anchor", "doc", "row", "start", F.posexplode("windows").alias("i", "hash"))
    single = single.select("anchor", "hash", "doc", "row", (F.col("start") + F.col("i")).alias("start"))
    earliest = single.groupBy("anchor", "hash").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = single.join(earliest.drop("n"), ["anchor", "hash"]).where(F.struct("doc", "start") > F.col("first"))
    return found.where("NOT is_first").select("doc", "row", "start", "n").unionByName(
        later.select("doc", "row", "start", F.lit(1).alias("n")))


def _cut(window: int, columns: list[str], with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            marks = part.column("_marks").to_pylist()
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for text, found in zip(texts_of(part.column("text")), marks):
                words = text.split()
                kept = words
                if found:
                    edges = np.zeros(len(words) + 1, np.int64)
                    begin = np.array([m["start"] for m in found])
                    end = begin + np.array([m["n"] for m in found]) + window - 1
                    np.add.at(edges, begin, 1)
                    np.add.at(edges, end, -1)
                    covered = np.cumsum(edges[:-1]) > 0
                    kept = [w for w, c in zip(words, covered.tolist()) if not c]
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                if with_text:
                    kept_texts.append(joined.decode() if found else None)
                else:
                    digests.append(hashlib.sha256(joined).hexdigest())
            out = [part.column(c) for c in columns] + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            out.append(pa.array(kept_texts if with_text else digests, pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=[*columns, "n_words", "n_removed", "kept_text" if with_text else "kept_sha256"])

    return cut


def _with_marks(docs: DataFrame, id_col: str, text_col: str, window: int, anchor: int, columns: list[str], with_text: bool) -> DataFrame:
    marks = repeated_windows(docs, id_col, text_col, window, anchor)
    marks = marks.groupBy("doc", "row").agg(F.collect_set(F.struct("start", "n")).alias("_marks"))
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    # Columns travel under numbers, so that names of the input cannot clash with those used here.
    names = [f"_{i}" for i in range(len(columns))]
    kinds = [docs.schema[c].dataType for c in columns]
    rows = docs.select(doc.alias("doc"), F.xxhash64(doc, F.col(f"`{text_col}`")).alias("row"), F.col(f"`{text_col}`").alias("text"),
                       *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)])
    joined = rows.join(marks, ["doc", "row"], "left").select("text", "_marks", *names)
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept_text" if with_text else "kept_sha256", "string")
    return joined.mapInArrow(_cut(window, names, with_text), schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The documents without the words under repeated windows; texts that lose nothing stay as they are.

    Kept words of a changed text are joined by one space.
    """
    others = [c for c in docs.columns if c != text_col]
    found = _with_marks(docs, id_col, text_col, window, anchor, [text_col, *others], True)
    text = F.coalesce(F.col("kept_text"), F.col("_0"))
    place = {c: F.col(f"_{i}").alias(c) for i, c in enumerate([text_col, *others])} | {text_col: text.alias(text_col)}
    return found.select(*[place[c] for c in docs.columns])


def count_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per document: id, n_words, n_removed and the SHA-256 of the kept words."""
    found = _with_marks(docs, id_col, text_col, window, anchor, [id_col], False)
    return found.select(F.col("_0").alias(id_col), "n_words", "n_removed", "kept_sha256")


ORACLE = r"""WITH w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p, len(ws) AS n
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents)),
h AS (
  SELECT doc_id, p, md5(k) AS k FROM (
    SELECT doc_id, p, n, string_agg(word, ' ') OVER (
      PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS k FROM w) WHERE p + 19 <= n),
f AS (SELECT k, min(doc_id) AS d, arg_min(p, (doc_id::HUGEINT * 1000000000 + p)) AS s FROM h GROUP BY k),
r AS (SELECT h.doc_id, h.p FROM h JOIN f USING (k) WHERE h.doc_id <> f.d OR h.p <> f.s),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM r),
m AS (SELECT w.doc_id, w.word, w.p, c.p IS NOT NULL AS gone FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.p = c.p),
a AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id"""


def op4_substring_dedup(spark, folder: str) -> DataFrame:
    """Words, removed words and the hash of the kept words of every document."""
    return count_repeats(documents(spark, folder))
