"""Toxicity scores of texts restored by a noisy channel.

Obfuscated words are restored first. Each noisy span (a word with leetspeak signs among its letters,
a letter three or more times in a row, or letters with gaps between them) is a lattice: every sign
has the letters it may stand for, a repeated letter or a separator may vanish, a gap may be nothing
or a word boundary. The Viterbi path through the lattice under a trigram character model gives the
restored word. A word without such signs has one path, itself. The character model counts the
trigrams in all runs of letters of all documents.

Scores come from a logistic model over the restored words and their beginnings of 4 to 6 letters
(runs of a letter count once), and over whether a text holds any strong one, whose share of toxic
texts is surely high (lower bound of the Wilson interval). Candidate features are those frequent in
toxic training texts; the best by chi-square get weights, fitted on at most ``TRAIN_ROWS`` labelled
rows, chosen by a hash of the id; equal texts count once. Scores use nothing but the text.

Null and empty texts have the score of a text without features. Null ids are scored, never learned
from and not held out. Several labels of one id count as toxic if one is; null labels are left out.
Without labels of both classes all texts get the same score. Repeated rows are scored each; extra
columns take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm.common import broadcast_value, documents, materialize, shared_value, slices, table, texts_of

#: Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¥": "y",
}
MASKS, ANY_LETTER = "*#%", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = ".-_~"
THRESHOLD = 0.3
TRAIN_ROWS = 20_000
CANDIDATES, FEATURES, MIN_TOXIC = 20_000, 1_000, 3
STRONG_SHARE, Z = 0.7, 1.96
BEGINNINGS = (4, 5, 6)
CACHE = 400_000
NONE: frozenset[int] = frozenset()
#: Letters beyond this count as one class in the character model, so it has a bounded size.
LAST_LETTER = "ſ"
OTHER = "\u0000"

EDGES = re.compile(r"^[^\w@$]+?(?=[\w@$]|[!|][^\W\d_]|$)|[^\w@$]+$")
SIGN_RUN = re.compile(r"([^\w\s])\1\1+$")
RUN = re.compile(r"(.)\1+")
LETTER, THRICE = re.compile(r"[^\W\d_]"), re.compile(r"([^\W\d_])\1\1")
SIGN_CLASS = re.escape("".join(SIGNS) + MASKS)
NOISY = re.compile(rf"[^\W\d_].*[{SIGN_CLASS}]|[{SIGN_CLASS}].*[^\W\d_]", re.S)
GAPPED = re.compile(r"^(?:[\w@$!|][.\-_~*])+[\w@$!|]$")


def letter(c: str) -> str:
    return c if "a" <= c <= LAST_LETTER else OTHER


class CharModel:
    """Interpolated trigram model over letters, ``^`` the start and ``$`` the end of a word."""

    def __init__(self, grams: dict[str, int]):
        self.tri, self.bi, self.uni, self.pair, self.one = grams, Counter(), Counter(), Counter(), Counter()
        for gram, n in grams.items():
            self.bi[gram[1:]] += n
            self.pair[gram[:2]] += n
            self.one[gram[1]] += n
            self.uni[gram[2]] += n
        self.total = max(1, sum(self.uni.values()))
        self.known: dict[str, float] = {}

    def cost(self, gram: str) -> float:
        """Negative log probability of the third letter after the first two."""
        found = self.known.get(gram)
        if found is None:
            three = self.tri.get(gram, 0) / self.pair[gram[:2]] if self.pair.get(gram[:2]) else 0.0
            two = self.bi.get(gram[1:], 0) / self.one[gram[1]] if self.one.get(gram[1]) else 0.0
            p = 0.75 * three + 0.2 * two + 0.049 * self.uni.get(gram[2], 0) / self.total + 1e-6
            found = self.known[gram] = -math.log(p)
        return found


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Per sign of a span the letters it may stand for, with their costs; '' drops it, ' ' ends a word."""
    out, before = [], ""
    for c in span:
        if c.isspace():
            out.append([("", 0.1), (" ", 2.5)])
        elif c in SIGNS:
            out.append([(x, 0.3) for x in SIGNS[c]] + [("", 6.0)])
        elif c in MASKS:
            out.append([(x, 1.0) for x in ANY_LETTER] + [("", 4.0)])
        elif c.isalpha():
            out.append([(c, 0.0), ("", 0.7)] if c == before else [(c, 0.0)])
        else:
            out.append([("", 0.5)])
        before = c
    return out


def decode(span: str, model: CharModel) -> str:
    """The words of the cheapest path through a span's lattice."""
    best: dict[str, tuple[float, tuple]] = {"^^": (0.0, ())}
    for choices in lattice(span):
        step: dict[str, tuple[float, tuple]] = {}
        for state, (cost, path) in best.items():
            for c, price in choices:
                if not c:
                    new, total, longer = state, cost + price, path
                elif c == " ":
                    if state == "^^":
                        continue
                    new, total, longer = "^^", cost + price + model.cost(state + "$"), (path, c)
                else:
                    x = letter(c)
                    new, total, longer = state[1] + x, cost + price + model.cost(state + x), (path, c)
                if new not in step or total < step[new][0]:
                    step[new] = (total, longer)
        best = step
    _, path = min(((cost + (model.cost(state + "$") if state != "^^" else 0.0), path) for state, (cost, path) in best.items()), key=lambda x: x[0], default=(0.0, ()))
    letters = []
    while path:
        path, c = path
        letters.append(c)
    return "".join(reversed(letters)).strip()


def core(word: str) -> str:
    return EDGES.sub("", SIGN_RUN.sub("", word))


def is_noisy(bare: str) -> bool:
    return bool(NOISY.search(bare) or THRICE.search(bare) or GAPPED.match(bare) and len(bare) > 4)


class Restorer(dict):
    """Word (bytes) -> restored words, remembered while they are few."""

    def __init__(self, model: CharModel):
        self.model = model

    def __missing__(self, word: bytes) -> list[str]:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = self.of(word)
        return value

    def of(self, word: bytes) -> list[str]:
        plain = word.decode("utf-8", "replace").lower()
        bare = plain if plain.isalpha() else core(plain)
        if (THRICE.search(bare) if bare.isalpha() else is_noisy(bare)):
            return decode(bare, self.model).split()
        return [bare] if bare else []


def spaced_runs(words: list[bytes]) -> list[tuple[int, int]]:
    """Runs of four and more single signs, as (begin, end)."""
    short = [i for i, w in enumerate(words) if len(w) <= 2 and (len(w) == 1 or w[0] >= 0xC0)]
    runs, begin = [], 0
    for j in range(1, len(short) + 1):
        if j == len(short) or short[j] != short[j - 1] + 1:
            if j - begin >= 4:
                runs.append((short[begin], short[j - 1] + 1))
            begin = j
    return runs


def restore(text: bytes, restorer: Restorer) -> list[str]:
    """The restored words of a text, lower-cased and without signs at their edges."""
    words, out, at = text.split(), [], 0
    for begin, end in spaced_runs(words):
        for w in words[at:begin]:
            out += restorer[w]
        out += decode(" ".join(w.decode().lower() for w in words[begin:end]), restorer.model).split()
        at = end
    for w in words[at:]:
        out += restorer[w]
    return out


def features_of(word: str) -> list[str]:
    plain = RUN.sub(r"\1", word) if RUN.search(word) else word
    return [f"{plain}$"] + [plain[:n] for n in BEGINNINGS if len(plain) >= n]


class FeatureIds(dict):
    """Word (bytes) -> numbers of the known features of its restored words."""

    def __init__(self, known: dict[str, int], restorer: Restorer):
        self.known, self.restorer = known, restorer
        self.starts = {f[:4] for f in known}

    def of(self, words: list[str]) -> frozenset[int]:
        known = self.known
        return frozenset(known[f] for w in words for f in features_of(w) if f in known) or NONE

    def __missing__(self, word: bytes) -> frozenset[int]:
        if len(self) >= CACHE:
            self.clear()
        plain = word.decode("utf-8", "replace").lower()
        if plain.isalpha() and not RUN.search(plain) and f"{plain}$"[:4] not in self.starts:
            value = NONE
        else:
            value = self.of(self.restorer.of(word))
        self[word] = value
        return value

    def text(self, text: bytes) -> set[int]:
        words = text.split()
        found: set[int] = set()
        found.update(*map(self.__getitem__, set(words)))
        for begin, end in spaced_runs(words):
            span = " ".join(w.decode().lower() for w in words[begin:end])
            found |= self.of(decode(span, self.restorer.model).split())
        return found


#: Codes of letters up to LAST_LETTER are their code points; then one for all other letters, and the end of a run.
OTHER_CODE, END_CODE = ord(LAST_LETTER) + 1, ord(LAST_LETTER) + 2


def _letter_codes(text: str) -> np.ndarray:
    """Code of each letter of a text, 0 for all other signs."""
    signs = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    known = np.array([i if chr(i).isalpha() else 0 for i in range(OTHER_CODE)])
    known[: ord("a")] = 0
    codes = known[np.minimum(signs, ord(LAST_LETTER))]
    far = signs > ord(LAST_LETTER)
    if far.any():
        letters = [c for c in np.unique(signs[far]).tolist() if chr(c).isalpha()]
        codes[far] = np.where(np.isin(signs[far], letters), OTHER_CODE, 0)
    return codes


def _gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams (rows of three codes, 0 before a run) of all runs of letters, and their numbers."""
    codes = np.concatenate([[0, 0], _letter_codes(text), [0]])
    last, before = codes[1:-1], codes[:-2]
    # What follows a run of letters is its end; what precedes its second letter is only the first.
    now = np.where((codes[2:] == 0) & (last > 0), END_CODE, codes[2:])
    before = np.where(last > 0, before, 0)
    used = np.flatnonzero(now)
    # Only the letters at hand, so that the table of all triples stays small.
    present = np.flatnonzero(np.bincount(now, minlength=END_CODE + 1))
    present = present if len(present) and present[0] == 0 else np.concatenate([[0], present])
    place = np.zeros(END_CODE + 1, np.int64)
    place[present] = np.arange(len(present))
    size = len(present)
    a, b, c = place[before[used]], place[last[used]], place[now[used]]
    counts = np.bincount((a * size + b) * size + c)
    found = np.flatnonzero(counts)
    return present[np.stack([found // size**2, found // size % size, found % size], axis=1)], counts[found]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams: Counter[tuple] = Counter()
    for part in slices(batches):
        text = b"\n".join(texts_of(part.column("text"))).decode("utf-8", "replace").lower()
        codes, counts = _gram_counts(text)
        for gram, n in zip(map(tuple, codes.tolist()), counts.tolist()):
            grams[gram] += n
    signs = {0: "^", OTHER_CODE: OTHER, END_CODE: "$"}
    names = ["".join(signs.get(c) or chr(c) for c in gram) for gram in grams]
    yield pa.RecordBatch.from_pydict({"gram": names, "n": list(grams.values())}, schema=pa.schema([("gram", pa.string()), ("n", pa.int64())]))


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trigrams of letters over all documents; their number is bounded by the letters told apart."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    grams = texts.mapInArrow(_count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return CharModel({r["gram"]: r["n"] for r in grams.collect()})


def held_out(doc: Column, modulus: int, rest: int) -> Column:
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, rest: int, id_col: str, text_col: str, most: int) -> DataFrame:
    """(doc, y, text) of at most about ``most`` labelled rows that are not held out."""
    doc = F.col(f"`{id_col}`")
    known = labels.select(doc.cast("long").alias("doc"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.where(F.col("doc").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc"), modulus, rest))
    known = known.groupBy("doc").agg(F.max("y").alias("y"))
    total = known.count()
    if total > most:
        known = known.where(F.pmod(F.xxhash64("doc", F.lit("train")), F.lit(1 << 30)) < int((1 << 30) * most / total))
    # At most about ``most`` rows of 12 bytes.
    return docs.select(doc.cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(known), "doc").select("doc", "y", "text")


@dataclass
class Model:
    chars: CharModel
    known: dict[str, int]
    #: One weight per known feature, and one for any strong feature.
    weights: np.ndarray
    bias: float
    strong: frozenset[int] = frozenset()

    def scorer(self) -> Callable[[bytes], float]:
        ids = FeatureIds(self.known, Restorer(self.chars))
        weights, bias, strong = self.weights.tolist(), self.bias, self.strong

        def score(text: bytes) -> float:
            found = ids.text(text)
            x = bias + sum(weights[i] for i in sorted(found))
            if not strong.isdisjoint(found):
                x += weights[-1]
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))

        return score


def _candidates(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, found = Restorer(shared_value(shared)), Counter()
        for part in slices(batches):
            for text in texts_of(part.column("text")):
                found.update({f for w in restore(text, restorer) for f in features_of(w)})
        yield pa.RecordBatch.from_pydict({"feature": list(found), "n": list(found.values())}, schema=pa.schema([("feature", pa.string()), ("n", pa.int64())]))

    return count


def _present(shared, known: dict[str, int]):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = FeatureIds(known, Restorer(shared_value(shared)))
        for part in slices(batches):
            found = [sorted(ids.text(t)) for t in texts_of(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("y"), pa.array(found, pa.list_(pa.int32()))], names=["doc", "y", "ids"])

    return mark


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, rest: int = 2, id_col: str = "doc_id",
        text_col: str = "text", train_rows: int = TRAIN_ROWS, features: int = FEATURES) -> Model:
    spark, tag = docs.sparkSession, uuid.uuid4().hex[:8]
    chars = char_model(docs, text_col)
    shared = broadcast_value(spark, chars)
    rows = training_rows(docs, labels, label, modulus, rest, id_col, text_col, train_rows)
    rows = materialize(rows.groupBy("text").agg(F.min("doc").alias("doc"), F.max("y").alias("y")), f"toxic-train-{tag}")
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, total = counts.get(1, 0), sum(counts.values())
    if not toxic or toxic == total:
        return Model(chars, {}, np.zeros(0), math.log((toxic + 0.5) / (total - toxic + 0.5)))
    counted = rows.where("y = 1").select("text").mapInArrow(_candidates(shared), "feature string, n long")
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TOXIC)
    names = [r["feature"] for r in counted.orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect()]
    present = materialize(rows.select("doc", "y", "text").mapInArrow(_present(shared, {n: i for i, n in enumerate(names)}), "doc long, y int, ids array<int>"), f"toxic-present-{tag}")
    seen = present.select("y", F.explode("ids").alias("id")).groupBy("id").agg(F.sum("y").alias("k"), F.count("*").alias("n"))
    stats = [(r["id"], r["k"], r["n"]) for r in seen.collect()]
    share = toxic / total
    best = sorted(((k - n * share) ** 2 / (n * share * (1 - share)), names[i], i) for i, k, n in stats if k > n * share)[::-1][:features]
    place = {i: j for j, (_, _, i) in enumerate(best)}
    strong = frozenset(place[i] for i, k, n in stats if i in place and surely(k, n) >= STRONG_SHARE)
    size = len(place)

    @F.udf(VectorUDT())
    def vector(ids):
        found = sorted({place[i] for i in ids if i in place})
        if not strong.isdisjoint(found):
            found.append(size)
        return Vectors.sparse(size + 1, found, [1.0] * len(found))

    points = materialize(present.select("doc", F.col("y").cast("double").alias("label"), vector("ids").alias("features")), f"toxic-points-{tag}")
    model = LogisticRegression(maxIter=100, regParam=1e-4, standardization=False, tol=1e-6).fit(points)
    return Model(chars, {names[i]: j for i, j in place.items()}, model.coefficients.toArray(), float(model.intercept), strong)


def surely(k: int, n: int) -> float:
    """Lower bound of the Wilson interval of a share k / n."""
    p, zz = k / n, Z * Z / n
    return (p + zz / 2 - Z * math.sqrt(p * (1 - p) / n + zz / (4 * n))) / (1 + zz)


def _score(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared_value(shared).scorer()
        for part in slices(batches, "_text"):
            scores = pa.array([of(t) for t in texts_of(part.column("_text"))], pa.float64())
            kept = part.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, scores], names=[*kept.schema.names, "_score"])

    return score


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1; a column of that name is replaced."""
    shared = broadcast_value(docs.sparkSession, model)
    columns = [c for c in docs.columns if c != name]
    fields = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(columns)]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)], F.col(f"`{text_col}`").alias("_text"))
    found = rows.mapInArrow(_score(shared), T.StructType([*fields, T.StructField("_score", T.DoubleType())]))
    return found.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(columns)], F.col("_score").alias(name))


def op1_toxicity(spark, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, folder, "labels"))).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
