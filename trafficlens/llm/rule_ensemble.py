"""Quality scores by a sparse ensemble of rules over text statistics.

Statistics of a text (shares of signs, capitals, digits, distinct words and so on) are Spark column
expressions. A random forest of shallow trees is grown on labelled rows; every path from a root to
a node below it is a rule, a conjunction of bounds on statistics. Lasso logistic regression over
the rules keeps few of them, and the kept ones with their weights become one column expression.

The fit uses at most about ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id, in one fixed
order, so that it does not depend on how the input is dealt out. Statistics and scores cover whole
texts of all documents.

Null and empty texts have all statistics 0. Null ids are scored, never learned from and not held
out. Several labels of one id count as good if one is; null labels are left out. Without labels of
both classes all texts get the same score. Repeated rows are scored each; extra columns are kept
and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import WORD, documents, materialize, table
from trafficlens.llm.toxicity import held_out, training_rows

TRAIN_ROWS = 20_000
TREES, DEPTH = 24, 3
LASSO = 1e-3
THRESHOLD = 0.5


def statistics(text: Column) -> dict[str, Column]:
    """Named numbers of a text; all 0 for one without words."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n_words, n_chars = F.size(words), F.length(text)
    per_word = lambda x: F.when(n_words > 0, x / n_words).otherwise(F.lit(0.0))
    per_char = lambda x: F.when(n_chars > 0, x / n_chars).otherwise(F.lit(0.0))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return {
        "words": F.log1p(n_words.cast("double")),
        "word_length": per_word(n_chars.cast("double")),
        "distinct_words": per_word(F.size(F.array_distinct(words)).cast("double")),
        "signs": per_char(count(r"[^\p{L}\p{N}\s]")),
        "odd_signs": per_word(count(r"[#$%&*|<>{}\[\]\\^~=+@_]")),
        "capitals": per_char(count(r"\p{Lu}")),
        "digits": per_char(count(r"\p{Nd}")),
        "sentence_ends": per_word(count(r"[.!?](?:\s|$)")),
        "exclamations": per_word(count(r"!")),
        "lines": per_word(count(r"\n")),
    }


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics: (name, above or not, value), all to hold."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self, prefix: str = "") -> Column:
        held = F.lit(True)
        for name, above, value in self.bounds:
            stat = F.col(f"`{prefix}{name}`")
            held = held & ((stat > value) if above else (stat <= value))
        return held

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if above else '<='} {v:.6g}" for n, above, v in self.bounds)


def _tightest(bounds: list[tuple[str, bool, float]]) -> Rule:
    """One bound per statistic and side."""
    kept: dict[tuple[str, bool], float] = {}
    for name, above, value in bounds:
        key = (name, above)
        kept[key] = value if key not in kept else (max if above else min)(kept[key], value)
    return Rule(tuple(sorted((n, a, v) for (n, a), v in kept.items())))


def tree_paths(node, names: list[str], bounds: tuple = ()) -> list[Rule]:
    """The rules of all nodes below a tree's root."""
    if node.getClass().getSimpleName() != "InternalNode":
        return [_tightest(list(bounds))] if bounds else []
    split = node.split()
    name, value = names[split.featureIndex()], float(split.threshold())
    below = tree_paths(node.leftChild(), names, (*bounds, (name, False, value)))
    above = tree_paths(node.rightChild(), names, (*bounds, (name, True, value)))
    return ([_tightest(list(bounds))] if bounds else []) + below + above


@dataclass
class Ensemble:
    rules: list[tuple[Rule, float]] = field(default_factory=list)
    bias: float = 0.0

    def column(self, prefix: str = "") -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3, rest: int = 1, id_col: str = "doc_id",
        text_col: str = "text", train_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Ensemble:
    tag = uuid.uuid4().hex[:8]
    stats = statistics(F.col("text"))
    names = list(stats)
    rows = training_rows(docs, labels, label, modulus, rest, id_col, text_col, train_rows)
    rows = materialize(rows.select("doc", F.col("y").cast("double").alias("label"), *[c.cast("double").alias(n) for n, c in stats.items()]), f"quality-train-{tag}")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, total = counts.get(1.0, 0), sum(counts.values())
    if not good or good == total:
        return Ensemble([], math.log((good + 0.5) / (total - good + 0.5)))
    # A bounded sample of numbers, in one order: the trees must not depend on partitions.
    rows = rows.coalesce(1).sortWithinPartitions("doc", *names)
    points = materialize(rows.select("label", array_to_vector(F.array(*names)).alias("features"), *names), f"quality-points-{tag}")
    points = points.coalesce(1)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, subsamplingRate=0.7, featureSubsetStrategy="onethird", maxBins=64).fit(points)
    rules = sorted({rule for tree in forest.trees for rule in tree_paths(tree._java_obj.rootNode(), names)}, key=lambda r: r.bounds)
    if not rules:
        return Ensemble([], math.log((good + 0.5) / (total - good + 0.5)))
    held = points.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features"))
    held = materialize(held, f"quality-rules-{tag}").coalesce(1)
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=100, standardization=False).fit(held)
    return Ensemble([(r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w], float(model.intercept))


def score(docs: DataFrame, ensemble: Ensemble, text_col: str = "text", name: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1; a column of that name is replaced."""
    needed = {n for rule, _ in ensemble.rules for n, _, _ in rule.bounds}
    kept = [c for c in docs.columns if c != name]
    prefix = "_stat_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    stats = statistics(F.col(f"`{text_col}`"))
    # Numbers first, in a projection of their own, so that each is computed once.
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], *[stats[n].cast("double").alias(prefix + n) for n in stats if n in needed])
    return rows.select(*[F.col(f"`{c}`") for c in kept], ensemble.column(prefix).alias(name))


def op2_quality(spark, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
