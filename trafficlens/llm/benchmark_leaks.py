"""Benchmark items in training documents: BM25 over an inverted index of items, by block-max WAND.

The test items are indexed (term -> items with BM25 impacts, in blocks with their largest impact).
Every document is cut into overlapping passages, and each passage is a query. Items of up to 64
words meet passages of 128 words; for longer ones the passage is twice the next power of two, so
each item lies whole in one of them and its passages depend on its own length alone. Impacts are divided by the score an item has for its own text,
so a score is the share of an item that a passage holds, and all items with a score of at least
``threshold`` are retrieved. A retrieved item counts as leaked if the passage also holds at least
``overlap`` of the three-word pieces of its question and of its answer.

The lists of the commonest terms are left to the end, as far as they give no item more than a fixed
share of the threshold: WAND runs over the other, essential lists with what those leave open as its
threshold, and the items it finds are scored in full. A passage whose essential terms cannot reach
that bound is not put to the index at all. Which terms are common is judged on a sample of the
documents; that choice only moves work and never changes what is found.

Question and answer: what stands up to the last question mark and after it; without one, the last
quarter of the words is the answer. Words are letters and digits, lower-cased.

Equal items are merged. The rest is cut by length class and hash into parts of about ``PART_BYTES``
of item text, with statistics over all items; each part's lists are built in a task. The driver
holds and sends out ``PART_BYTES`` of parts at a time, which all documents meet in one pass.
Adding items changes the rows of others through the BM25 statistics only.

Null and empty texts (of documents and of items) match nothing. Null item ids are allowed. Equal
items are found each; repeated rows of documents give a row each. Extra columns take no part. Empty tables give an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm.common import documents, materialize, slices, table, texts_of
from trafficlens.session import broadcast_if_small

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.6
PIECE = 3
PASSAGE = 128
BLOCK = 32
PART_BYTES = 16 << 20
COMMON_SHARE = 0.95
SAMPLE = 0.01
CACHE = 500_000


def normal(word: bytes) -> str:
    plain = word.decode("utf-8", "replace").lower()
    return plain if plain.isalnum() else "".join(filter(str.isalnum, plain))


def words_of(text: bytes) -> list[str]:
    return [w for w in map(normal, text.split()) if w]


def answer_start(text: bytes) -> int:
    """The number of words of the question."""
    words = words_of(text)
    head, mark, tail = text.rpartition(b"?")
    if mark and words_of(tail):
        return len(words_of(head))
    return len(words) - max(1, len(words) // 4)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array([words_of(t) for t in texts], pa.list_(pa.string())), pa.array([answer_start(t) for t in texts], pa.int32())],
            names=["item", "words", "answer"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for part in slices(batches):
        for text in texts_of(part.column("text")):
            counts.update(words_of(text))
    yield pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())}, schema=pa.schema([("term", pa.string()), ("n", pa.int64())]))


class Index:
    """Inverted index of some items (name, words, length of the question), with statistics over all items."""

    def __init__(self, items: list[tuple], df: dict[str, int], n_items: int, mean_length: float, threshold: float, seen: dict[str, int]):
        self.items = items
        self.terms: dict[str, int] = {}
        lists: list[list[tuple[int, float]]] = []
        self.length = passage_length(max((len(w) for _, w, _ in items), default=1))
        for number, (_, words, _) in enumerate(items):
            impact = {}
            for term, tf in Counter(words).items():
                idf = math.log(1 + (n_items - df[term] + 0.5) / (df[term] + 0.5))
                impact[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_length))
            whole = sum(impact.values())
            for term, value in impact.items():
                at = self.terms.setdefault(term, len(lists))
                if at == len(lists):
                    lists.append([])
                lists[at].append((number, value / whole))
        self.postings = [([i for i, _ in x], [v for _, v in x]) for x in lists]
        self.top = [max(v) for _, v in self.postings]
        self.block_top = [[max(v[i : i + BLOCK]) for i in range(0, len(v), BLOCK)] for _, v in self.postings]
        # Common terms: the most frequent in the documents, as long as they give no item more than their share.
        room = [threshold * COMMON_SHARE] * len(items)
        self.common = np.zeros(len(lists), bool)
        for term, at in sorted(self.terms.items(), key=lambda x: (-seen.get(x[0], 0), x[0])):
            found, values = self.postings[at]
            if all(room[i] >= v for i, v in zip(found, values)):
                for i, v in zip(found, values):
                    room[i] -= v
                self.common[at] = True
        self.open = threshold - (threshold * COMMON_SHARE - min(room, default=0.0))
        self.impacts: list[dict[int, float]] = [{} for _ in items]
        for at, (found, values) in enumerate(self.postings):
            for i, v in zip(found, values):
                self.impacts[i][at] = v
        self.rare_top = np.where(self.common, 0.0, np.array(self.top))
        self.pieces = [
            (pieces([self.terms[w] for w in words[:answer]]), pieces([self.terms[w] for w in words[answer:]]))
            for _, words, answer in items
        ]

    def search(self, terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose score reaches the threshold."""
        hits = []
        for number, _ in self._wand([t for t in terms if not self.common[t]], self.open):
            held = self.impacts[number]
            score = math.fsum(held[t] for t in held.keys() & terms)
            if score >= threshold - 1e-9:
                hits.append((number, score))
        return hits

    def _wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose essential terms reach the threshold, by block-max WAND."""
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        hits, least = [], threshold - 1e-9
        while True:
            cursors = [c for c in cursors if c[0] >= 0]
            cursors.sort()
            total, pivot = 0.0, -1
            for j, c in enumerate(cursors):
                total += self.top[c[2]]
                if total >= least:
                    pivot = j
                    break
            if pivot < 0:
                return hits
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, next_item = 0.0, math.inf
            for c in cursors[: pivot + 1]:
                found = self.postings[c[2]][0]
                block = c[1] // BLOCK
                while found[min((block + 1) * BLOCK, len(found)) - 1] < item:
                    block += 1
                    if block * BLOCK >= len(found):
                        break
                if block * BLOCK < len(found):
                    bound += self.block_top[c[2]][block]
                    next_item = min(next_item, found[min((block + 1) * BLOCK, len(found)) - 1] + 1)
            if bound < least:
                # No item up to the end of the nearest block can reach the threshold.
                if pivot + 1 < len(cursors):
                    next_item = min(next_item, cursors[pivot + 1][0])
                for c in cursors[: pivot + 1]:
                    self._advance(c, max(next_item, item + 1))
            elif cursors[0][0] == item:
                score = sum(self.postings[c[2]][1][c[1]] for c in cursors[: pivot + 1])
                if score >= least:
                    hits.append((item, score))
                for c in cursors[: pivot + 1]:
                    self._advance(c, item + 1)
            else:
                for c in cursors[:pivot]:
                    if c[0] < item:
                        self._advance(c, item)

    def _advance(self, cursor: list, item: float) -> None:
        found, at = self.postings[cursor[2]][0], cursor[1]
        while at < len(found) and found[at] < item:
            at += 1
        cursor[0], cursor[1] = (found[at], at) if at < len(found) else (-1, at)


def pieces(ids: list[int]) -> set[tuple]:
    size = min(PIECE, len(ids))
    return {tuple(ids[i : i + size]) for i in range(len(ids) - size + 1)} if size else set()


def share_held(part: set[tuple], passage: list[int]) -> float:
    """Share of a question's or answer's pieces in a passage; nothing to hold counts as held."""
    if not part:
        return 1.0
    size = len(next(iter(part)))
    held = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
    return len(part & held) / len(part)


class TermIds(dict):
    def __init__(self, terms: dict[str, int]):
        self.terms = terms

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        plain = normal(word)
        # Words without letters and digits are left out (-2), others that no item has break pieces (-1).
        value = self[word] = self.terms.get(plain, -1) if plain else -2
        return value


def passage_length(words: int) -> int:
    """Length of the passages for an item of so many words."""
    return max(PASSAGE, 2 << (words - 1).bit_length())


def passages(counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, begin, end) of overlapping passages; a step is half a passage."""
    step = length // 2
    n = np.maximum(1, -(-(counts - step) // step))
    n[counts == 0] = 0
    doc = np.repeat(np.arange(len(counts)), n)
    first = np.cumsum(n) - n
    begin = (np.arange(n.sum()) - np.repeat(first, n)) * step
    base = np.cumsum(counts) - counts
    return doc, base[doc] + begin, base[doc] + np.minimum(begin + length, counts[doc])


class Finder:
    """Leaked items in batches of texts."""

    def __init__(self, indexes: list[Index], threshold: float, overlap: float):
        self.threshold, self.overlap = threshold, overlap
        terms: dict[str, int] = {}
        for index in indexes:
            for term in index.terms:
                terms.setdefault(term, len(terms))
        self.ids = TermIds(terms)
        self.indexes = []
        for index in indexes:
            # The index's number of each term; unknown words (-1) read the last place.
            own = np.full(len(terms) + 1, -1, np.int32)
            own[[terms[t] for t in index.terms]] = list(index.terms.values())
            self.indexes.append((index, own, np.concatenate([index.rare_top, [0.0]])))

    def find(self, texts: list[bytes]) -> dict[tuple[int, str], tuple[float, float, float]]:
        """(text, name of the item) -> best score and overlaps."""
        lists = [t.split() for t in texts]
        words = np.fromiter(map(self.ids.__getitem__, chain.from_iterable(lists)), np.int32)
        of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        of, words = of[words > -2], words[words > -2]
        counts = np.bincount(of, minlength=len(lists)).astype(np.int64)
        best: dict[tuple[int, str], tuple] = {}
        for index, own, weights in self.indexes:
            flat = own[words]
            doc, begin, end = passages(counts, index.length)
            sums = np.concatenate([[0.0], np.cumsum(weights[flat])])
            for j in np.flatnonzero(sums[end] - sums[begin] >= index.open - 1e-6).tolist():
                passage = flat[begin[j] : end[j]].tolist()
                for number, score in index.search(set(passage) - {-1}, self.threshold):
                    question, answer = (share_held(p, passage) for p in index.pieces[number])
                    if question >= self.overlap and answer >= self.overlap:
                        key = (int(doc[j]), index.items[number][0])
                        best[key] = max(best.get(key, (0.0,)), (score, question, answer))
        return best


def _restored(shared: Broadcast) -> list[Index]:
    """Indexes from their values, in a task."""
    found = []
    for values in shared.value:
        index = Index.__new__(Index)
        vars(index).update(pickle.loads(values))
        found.append(index)
    return found


def _reporter(shared: Broadcast, threshold: float, overlap: float):
    schema = pa.schema([("doc", pa.int64()), ("key", pa.string()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(_restored(shared), threshold, overlap)
        for part in slices(batches):
            best = finder.find(texts_of(part.column("text")))
            if best:
                docs = part.column("doc").take(pa.array([d for d, _ in best]))
                scores = list(zip(*best.values()))
                yield pa.RecordBatch.from_arrays([docs, pa.array([k for _, k in best]), *[pa.array(s, pa.float64()) for s in scores]], schema=schema)

    return report


def _remover(shared: Broadcast, threshold: float, overlap: float):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(_restored(shared), threshold, overlap)
        for part in slices(batches, "_text"):
            leaked = {d for d, _ in finder.find(texts_of(part.column("_text")))}
            yield part.filter(pa.array([i not in leaked for i in range(part.num_rows)], pa.bool_())) if leaked else part

    return remove


def _builder(n_items: int, mean_length: float, threshold: float):
    def build(part: pa.Table) -> pa.Table:
        rows = sorted(part.select(["key", "words", "answer", "terms"]).to_pylist(), key=lambda r: r["key"])
        terms = [t for r in rows for t in r["terms"]]
        index = Index([(r["key"], r["words"], r["answer"]) for r in rows], {t["term"]: t["df"] for t in terms}, n_items, mean_length, threshold,
                      {t["term"]: t["n"] or 0 for t in terms})
        return pa.table({"length": part.column("length")[:1], "part": part.column("part")[:1], "index": pa.array([pickle.dumps(vars(index))], pa.binary())})

    return build


def named_items(items: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """(item, words, answer, key) of all items with words; equal items have one key."""
    named = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text"))
    words = named.mapInArrow(_item_words, "item long, words array<string>, answer int").where(F.size("words") > 0)
    return materialize(words.withColumn("key", F.sha2(F.concat_ws(" ", F.col("answer").cast("string"), "words"), 256)), "leak-items")


def _length_class() -> Column:
    """:func:`passage_length` of the item as a column."""
    return F.greatest(F.lit(PASSAGE), F.expr("shiftleft(2, if(size(words) = 1, 0, length(bin(size(words) - 1))))"))


def indexes(texts: DataFrame, words: DataFrame, threshold: float, part_bytes: int) -> Iterator[Broadcast]:
    """The items' index, a bounded number of parts at a time, sent to the tasks."""
    spark = words.sparkSession
    stats = words.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean")).first()
    if not stats["n"]:
        return
    df = words.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    sampled = texts.sample(SAMPLE, seed=1).mapInArrow(_word_counts, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    merged = words.groupBy("key").agg(F.first("words").alias("words"), F.first("answer").alias("answer")).withColumn("length", _length_class())
    sizes = merged.groupBy("length").agg(F.sum(F.length(F.array_join("words", " "))).alias("size"))
    parts = {r["length"]: -(-r["size"] // part_bytes) for r in sizes.collect()}  # one row per power of two
    count = F.coalesce(*[F.when(F.col("length") == length, n) for length, n in parts.items()])
    dealt = merged.withColumn("part", F.pmod(F.xxhash64("key"), count))
    known = merged.select("key", F.explode(F.array_distinct("words")).alias("term")).join(df, "term").join(sampled, "term", "left")
    with_terms = dealt.join(known.groupBy("key").agg(F.collect_list(F.struct("term", "df", "n")).alias("terms")), "key")
    built = materialize(with_terms.groupBy("length", "part").applyInArrow(
        _builder(stats["n"], stats["mean"], threshold), "length int, part long, index binary"), "leak-index")
    held: list[bytes] = []
    places = built.select("length", "part", F.length("index").alias("size")).orderBy("length", "part").collect()  # one short row per part
    for place in places:
        if held and sum(map(len, held)) + place["size"] > part_bytes:
            yield spark.sparkContext.broadcast(held)
            held = []
        held.append(bytes(built.where((F.col("length") == place["length"]) & (F.col("part") == place["part"])).first()["index"]))
    yield spark.sparkContext.broadcast(held)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every document that holds an item."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    words = named_items(items, item_col, item_text)
    names = broadcast_if_small(words.select("key", F.col("item").alias("item_id")))
    found = spark.createDataFrame([], "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
    for shared in indexes(rows.select("text"), words, threshold, part_bytes):
        hits = rows.mapInArrow(_reporter(shared, threshold, overlap), "doc long, key string, score double, question_overlap double, answer_overlap double")
        found = found.unionByName(hits.join(names, "key").select(F.col("doc").alias("doc_id"), "item_id", "score", "question_overlap", "answer_overlap"))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  threshold: float = THRESHOLD, overlap: float = OVERLAP, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents that hold no item, without a shuffle of documents."""
    fields = [T.StructField(f"_{i}", f.dataType) for i, f in enumerate(docs.schema)]
    at = docs.columns.index(text_col)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)], F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType([*fields, T.StructField("_text", docs.schema[at].dataType)])
    for shared in indexes(docs.select(F.col(f"`{text_col}`").alias("text")), named_items(items, item_col, item_text), threshold, part_bytes):
        rows = rows.mapInArrow(_remover(shared, threshold, overlap), schema)
    return rows.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op5_benchmark_leaks(spark, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the overlaps."""
    return leaks(documents(spark, folder), table(spark, folder, "benchmark"))
