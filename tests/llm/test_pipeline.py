from __future__ import annotations

import hashlib

import corpus_pipeline
from cases import documents, with_clashes, words
from test_order_minhash import brute_classes, edited
from test_repeats import brute as brute_repeats

from trafficlens.llm import toxicity
from trafficlens.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "repeated passages", "benchmark leaks", "source mix"]
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, folder), "test-stage")
        assert set(docs.columns) >= set(COLUMNS)
        if number < 4:
            assert docs.columns == COLUMNS and docs.dtypes == before.dtypes
        assert docs.count() <= before.count()
    assert 0 < docs.count()


def test_toxic_documents_go_and_clean_ones_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")).scorer()
    want = {r["doc_id"] for r in docs.collect() if model((r["text"] or "").encode()) < 0.3}
    assert {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()} == want
    assert len(want) > 0.8 * docs.count()


def test_one_of_each_near_duplicate_stays(spark, folder):
    base = words(100, seed=1)
    texts = [words(80, seed=9), base, edited(base, 1, 1), base, edited(base, 2, 2), words(60, seed=3), None, None]
    classes = brute_classes(list(enumerate(texts)))
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, texts), folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in classes})


def test_repeated_passages_go(spark, folder):
    passage = words(60, seed=1)
    texts = [words(10, seed=k) + " " + passage + "\n " + words(15, seed=k + 50) for k in range(4)] + ["as  it\nis", None]
    got = {r["doc_id"]: r for r in corpus_pipeline.cut_repeated_passages(spark, documents(spark, texts), folder).collect()}
    for doc, _, removed, digest in brute_repeats(list(enumerate(texts)), 20):
        text = got[doc]["text"]
        if removed:
            assert hashlib.sha256(text.encode()).hexdigest() == digest and got[doc]["n_chars"] == len(text)
        else:
            assert text == texts[doc]


def test_extra_columns_pass(spark, folder):
    texts = [words(50, seed=k) for k in range(30)]
    docs = with_clashes(documents(spark, texts))
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder)
        assert docs.count() == 30 and {r["score"] for r in docs.collect()} == {"other score"}
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    assert {r["rank"] for r in mixed.collect()} == {"other rank"}


def test_empty_documents(spark, folder):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []


def test_entry_has_the_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES)
