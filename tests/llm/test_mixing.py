from __future__ import annotations

from collections import Counter

import pytest
from cases import documents, with_clashes, words
from pyspark.sql import functions as F

from trafficlens.llm import mixing


def brute_targets(sizes, cap=3.0, shares=(1, 2, 3)):
    """Share by weight; cap; share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float(shares[i % len(shares)]) for i, s in enumerate(order)}
    total, capped = float(sum(sizes.values())), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] for s in capped} | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > cap * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def spread(spark, seed, n=400):
    texts = [words(5 + (k * 7919 + seed) % 40, seed=k) for k in range(n)]
    names = [None, "a", "b", "c", "é", "z"]
    sources = [names[(k * k + seed) % 6] if k % 3 else "hot" for k in range(n)]
    return documents(spark, texts, sources=sources), texts, sources


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_targets_and_taken_words(spark, seed):
    df, texts, sources = spread(spark, seed)
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len(t.split())
    want = brute_targets(sizes)
    rows = mixing.mix(df).collect()
    taken, largest = Counter(), Counter()
    for r in rows:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_the_cut_does_not_depend_on_bins(spark):
    df, _, _ = spread(spark, 5)
    one = {(r["doc_id"], r["taken"]) for r in mixing.mix(df, bins=1).collect()}
    assert one == {(r["doc_id"], r["taken"]) for r in mixing.mix(df.repartition(7), bins=4096).collect()}


def test_target_rule_with_extreme_sizes(spark):
    for sizes in ({"a": 1, "b": 1000, "c": 10}, {"a": 0, "b": 0}, {"a": 5}, {None: 7, "a": 100, "b": 3, "c": 3}, {"a": 1, "b": 1, "c": 10**9}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert got == pytest.approx(want, abs=1e-6)


def test_awkward_rows(spark):
    texts = [None, "", "  ", "a b", "a b", "a b c", words(50_000)]
    df = with_clashes(documents(spark, texts, [1, 2, 3, 4, 4, None, 5], [None, "x", "x", "x", "x", None, "y"]))
    rows = mixing.mix(df, carry=True)
    assert sorted(r["size"] for r in rows.collect()) == [0, 0, 0, 2, 2, 3, 50_000]
    assert {tuple(r["row"]) for r in rows.collect()} == {tuple(r) for r in df.collect()}
    equal = [r["taken"] for r in rows.where(F.col("doc_id") == 4).collect()]
    assert len(equal) == 2
    assert all(r["taken"] <= 3 * r["size"] for r in rows.collect())


def test_reruns_agree(spark):
    df, _, _ = spread(spark, 3)
    assert sorted(map(str, mixing.mix(df).collect())) == sorted(map(str, mixing.mix(df.repartition(3)).collect()))


def test_empty_table(spark):
    assert mixing.mix(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark, folder):
    from trafficlens.llm.queries import QUERIES

    for name in ("op6_url_filters", "op10_mixing"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
