from __future__ import annotations

import math
import re

import pytest
from cases import crc_rest, documents, with_clashes, words
from pyspark.sql import functions as F
from test_toxicity import auc

from trafficlens.llm import rule_ensemble as rules
from trafficlens.llm.queries import QUERIES


def brute_statistics(text):
    text = text or ""
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    n, chars = max(1, len(ws)), max(1, len(text))
    return {
        "words": math.log1p(len(ws)),
        "word_length": len(text) / n if ws else 0.0,
        "distinct_words": len(set(ws)) / n,
        "signs": sum(not (c.isalpha() or c.isnumeric() or c.isspace()) for c in text) / chars,
        "odd_signs": len(re.findall(r"[#$%&*|<>{}\[\]\\^~=+@_]", text)) / n if ws else 0.0,
        "capitals": sum(c.isupper() for c in text) / chars,
        "digits": sum(c.isdecimal() for c in text) / chars,
        "sentence_ends": len(re.findall(r"[.!?](?:\s|$)", text)) / n if ws else 0.0,
        "exclamations": text.count("!") / n if ws else 0.0,
        "lines": text.count("\n") / n if ws else 0.0,
    }


def test_statistics_equal_brute_force(spark):
    texts = [None, "", " ", "A b. C!\nd | # é É ß 12 a a", "word " * 300, words(5000), "!!! ###"]
    df = documents(spark, texts)
    got = df.select("doc_id", *[c.alias(n) for n, c in rules.statistics(F.col("text")).items()]).collect()
    for r in got:
        for name, value in brute_statistics(texts[r["doc_id"]]).items():
            assert r[name] == pytest.approx(value, abs=1e-9), (texts[r["doc_id"]], name)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, folder).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (crc_rest(r["doc_id"], 3) == 1) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    kept = [(labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert auc(*zip(*kept)) > 0.9


def sample(spark, n=200):
    texts = [words(40, seed=i) if i % 3 else "! # $ " * 10 + words(3, seed=i) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(n)], "doc_id long, quality int")
    return documents(spark, texts), labels


def test_rules_are_conjunctions_with_few_weights(spark):
    docs, labels = sample(spark)
    found = rules.fit(docs, labels)
    assert 0 < len(found.rules) < 60 and all(rule.bounds and w for rule, w in found.rules)
    again = rules.fit(docs.repartition(7), labels.repartition(3))
    assert [str(r) for r, _ in again.rules] == [str(r) for r, _ in found.rules]
    # The compiled column equals the rules evaluated one by one.
    stats = {r["doc_id"]: r for r in docs.select("doc_id", *[c.alias(n) for n, c in rules.statistics(F.col("text")).items()]).collect()}
    for r in rules.score(docs, found).collect():
        total = found.bias
        for rule, weight in found.rules:
            if all((stats[r["doc_id"]][n] > v) == above for n, above, v in rule.bounds):
                total += weight
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_held_out_labels_do_not_matter(spark):
    docs, labels = sample(spark)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) AS quality")
    assert rules.fit(docs, flipped) == rules.fit(docs, labels)


def test_awkward_rows(spark):
    docs, labels = sample(spark)
    model = rules.fit(docs.unionByName(documents(spark, [None, ""], [None, 900])), labels.union(spark.createDataFrame([(None, 1), (2, None)], labels.schema)))
    df = with_clashes(documents(spark, [None, "", "a", "a", words(100_000)], [0, 1, 2, 2, None])).withColumn("_stat_words", F.lit("x"))
    scored = rules.score(df, model, name="score")
    assert scored.count() == 5 and {r["_stat_words"] for r in scored.collect()} == {"x"}
    assert len({r["score"] for r in scored.where("doc_id < 2").collect()}) == 1


def test_without_both_classes_or_rows(spark):
    docs, labels = sample(spark, 30)
    for known in (labels.where("quality = 0"), labels.where("false")):
        assert len({r["score"] for r in rules.score(docs, rules.fit(docs, known)).collect()}) == 1
    none = documents(spark, [])
    assert rules.score(none, rules.fit(none, labels)).collect() == []
