from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import encoding
from trafficlens.operators.ordering import dense_ids, exact_quantiles, running_totals
from trafficlens.operators.sampling import hash_split, restamp_hourly, stratified_split


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_ids(spark, parts):
    rng = random.Random(1)
    rows = [(rng.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, id int").repartition(parts)
    got = {(r["k"], r["id"]): r["n"] for r in dense_ids(df, ["k", "id"], "n").collect()}
    assert got == {row: i + 1 for i, row in enumerate(sorted(rows))}


def test_dense_ids_of_empty_and_single(spark):
    empty = spark.createDataFrame([], "id int")
    assert dense_ids(empty, ["id"], "n").collect() == []
    single = spark.createDataFrame([(9,)], "id int")
    assert dense_ids(single, ["id"], "n", start=0).first()["n"] == 0


def test_hot_key_is_split(spark):
    """All rows share the leading key; the unique one still spreads them."""
    from trafficlens.operators.ordering import PART, range_ordered

    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id").repartition(4)
    sizes = [r["count"] for r in range_ordered(df, ["k", "id"]).groupBy(PART).count().collect()]
    assert sum(sizes) == 20_000


def test_running_totals(spark):
    rows = [(i, i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(5)
    got = {r["id"]: r["t"] for r in running_totals(df, ["id"], {"t": "v"}).collect()}
    assert [got[i] for i in range(300)] == list(np.cumsum([v for _, v in rows]))


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.normal(0, 1, 700), np.zeros(400), rng.exponential(1e6, 50)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.731, 0.99, 1.0]
    assert exact_quantiles(df, "v", probs, bins=16) == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_quantiles_of_little_data(spark):
    df = spark.createDataFrame([(None,), (4.0,), (float("nan"),)], "v double")
    assert exact_quantiles(df, "v", [0.1, 0.9]) == [4.0, 4.0]
    assert exact_quantiles(df.filter("v is null"), "v", [0.5]) == [None]


def test_encoder_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "s string")
    encoder = encoding.fit_encoder(train, "s")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "zz"), (4, None)], "id int, s string")
    coded = encoding.apply_encoder(new, encoder, "s").orderBy("id").collect()
    assert [r["s_encoded"] for r in coded] == [0, 1, 2, None]
    back = encoding.decode(encoding.apply_encoder(new, encoder, "s"), encoder, "s_encoded", "name")
    assert [r["name"] for r in back.orderBy("id").collect()] == ["a", "b", None, None]


def test_encoder_without_broadcast_gives_the_same(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"v{i}") for i in range(600)] + [(601, None), (602, "new")]
    df = spark.createDataFrame(rows, "id int, s string")
    encoder = encoding.fit_encoder(df.filter("id < 601"), "s")
    small = {r["id"]: r["s_encoded"] for r in encoding.apply_encoder(df, encoder, "s").collect()}
    monkeypatch.setattr(encoding, "broadcast_if_small", lambda table: table)
    large = {r["id"]: r["s_encoded"] for r in encoding.apply_encoder(df, encoder, "s").collect()}
    assert small == large and len(large) == len(rows)
    names = sorted({s for i, s in rows if i < 601})
    assert large[1] == names.index("hot") and large[602] == len(names)


def test_vocabulary_over_two_columns(spark):
    df = spark.createDataFrame([("a", "b"), ("b", None)], "s string, t string")
    got = {r["value"]: r["frequency"] for r in encoding.vocabulary(df, "s", "t").collect()}
    assert got == {"a": 1, "b": 2}


@pytest.mark.parametrize("parts", [1, 8])
def test_hash_split_ignores_partitioning(spark, parts):
    df = spark.range(2000).repartition(parts)
    test = {r["id"] for r in hash_split(df, "id").filter("split = 'test'").collect()}
    again = {r["id"] for r in hash_split(spark.range(2000), "id").filter("split = 'test'").collect()}
    assert test == again
    assert 0.16 < len(test) / 2000 < 0.24


@pytest.mark.parametrize("digits", [0, 1, 4])
def test_stratified_split_is_exact_per_class(spark, digits):
    df = spark.range(1000).select("id", F.when(F.col("id") < 33, 1).when(F.col("id") < 900, 0).alias("label"))
    got = stratified_split(df, "id", "label", cell_digits=digits)
    counts = {(r["label"], r["split"]): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert counts == {
        (1, "test"): 7, (1, "train"): 26, (0, "test"): 173, (0, "train"): 694, (None, "test"): 20, (None, "train"): 80,
    }
    assert got.columns == ["id", "label", "split"]


def test_stratified_split_extremes(spark):
    df = spark.range(10).select("id", F.lit("x").alias("label"))
    assert {r["split"] for r in stratified_split(df, "id", "label", 0).collect()} == {"train"}
    assert {r["split"] for r in stratified_split(df, "id", "label", 100).collect()} == {"test"}


def test_restamp_hourly(spark):
    df = spark.sql("SELECT * FROM VALUES (3, timestamp'2020-01-02'), (1, timestamp'2020-01-05'), (2, timestamp'2020-01-02') AS t(id, at)")
    got = restamp_hourly(df, "at", "id", "2025-12-10 00:00:00").selectExpr("id", "cast(at as string) at")
    assert {r["id"]: r["at"] for r in got.collect()} == {
        2: "2025-12-10 00:00:00", 3: "2025-12-10 01:00:00", 1: "2025-12-10 02:00:00",
    }
