from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from cases import documents, with_clashes, words

from trafficlens.llm import benchmark_leaks as bl


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def index_of(texts, threshold=bl.THRESHOLD, seen=None):
    held = [(i, bl.words_of(t.encode()), bl.answer_start(t.encode())) for i, t in enumerate(texts)]
    df = Counter(w for _, ws, _ in held for w in set(ws))
    mean = sum(len(ws) for _, ws, _ in held) / len(held)
    return bl.Index(held, df, len(held), mean, threshold, seen or {})


def test_search_finds_all_above_the_threshold():
    r = random.Random(1)
    texts = [words(r.randrange(3, 60), seed=k, vocabulary=80) for k in range(150)]
    for threshold in (0.2, 0.5, 0.6, 0.9):
        index = index_of(texts, threshold, seen={f"w{k}": 80 - k for k in range(80)})
        for k in range(150):
            terms = {index.terms[w] for w in words(r.randrange(1, 40), seed=500 + k, vocabulary=80).split() if w in index.terms}
            want = {}
            for t in terms:
                for i, v in zip(*index.postings[t]):
                    want[i] = want.get(i, 0.0) + v
            got = dict(index.search(terms, threshold))
            assert set(got) == {i for i, v in want.items() if v >= threshold - 1e-9}
            assert all(math.isclose(got[i], want[i]) for i in got)


def brute(docs, texts, threshold, overlap):
    """Every item against every passage of the length that its own number of words asks for."""
    index = index_of(texts, threshold)
    ids, out = bl.TermIds(index.terms), set()
    for d, text in docs:
        flat = [x for x in map(ids.__getitem__, (text or "").encode().split()) if x > -2]
        for i, item in enumerate(texts):
            half = 64
            while half < len(item.split()):
                half *= 2
            for begin in range(0, max(1, len(flat)), half):
                passage = flat[begin : begin + 2 * half]
                score = sum(index.impacts[i].get(t, 0.0) for t in set(passage))
                q, a = (bl.share_held(p, passage) for p in index.pieces[i])
                if score >= threshold and q >= overlap and a >= overlap:
                    out.add((d, i))
    return out


def test_equals_brute_force(spark):
    r = random.Random(2)
    tests = [words(r.randrange(10, 60) if k % 6 else r.randrange(60, 300), seed=900 + k, vocabulary=700) for k in range(30)]
    docs = []
    for k in range(60):
        text = words(r.randrange(0, 400), seed=k, vocabulary=700).split()
        if k % 2:
            item = tests[r.randrange(30)].split()
            item = item[: len(item) - r.randrange(len(item) // 2)]
            at = r.randrange(len(text) + 1)
            text[at:at] = [w.upper() + "," if r.random() < 0.3 else w for w in item]
        docs.append((k, " ".join(text)))
    df = documents(spark, [t for _, t in docs])
    for part_bytes in (1 << 20, 1500):
        got = bl.leaks(df, items(spark, list(enumerate(tests))), part_bytes=part_bytes)
        assert {(x["doc_id"], x["item_id"]) for x in got.collect()} == brute(docs, tests, bl.THRESHOLD, bl.OVERLAP)


def test_other_items_and_parts_change_nothing(spark):
    question = words(20, seed=31, vocabulary=500) + "?"
    answer = words(12, seed=32, vocabulary=500)
    apart = f"{question} {words(600, seed=33)} {answer}"
    df = documents(spark, [apart, f"x {question} {answer} y", words(100, seed=34)])
    few = [(1, f"{question} {answer}"), (2, words(40, seed=35))]
    long = " ".join(f"q{k}" for k in range(1500))
    many = [*few, (3, long), (4, long), *[(10 + k, " ".join(f"z{k}x{j}" for j in range(5 + 9 * k))) for k in range(20)]]
    for rows in (few, many):
        for part_bytes in (1 << 24, 4000):
            got = bl.leaks(df, items(spark, rows), part_bytes=part_bytes)
            assert [(x["doc_id"], x["item_id"]) for x in got.collect()] == [(1, 1)]
            assert sorted(x["doc_id"] for x in bl.without_leaks(df, items(spark, rows), part_bytes=part_bytes).collect()) == [0, 2]


def test_passage_length_follows_the_item():
    assert [bl.passage_length(n) for n in (1, 2, 63, 64, 65, 128, 129, 1500)] == [128, 128, 128, 128, 256, 256, 512, 4096]


def test_question_and_answer_must_both_be_held(spark):
    question = "which of the two rivers that cross the northern valley carries more water in spring?"
    answer = "the eastern one because of melting snow"
    df = documents(spark, [question, answer, f"intro {question} {answer} end", f"{answer} {words(300)} {question}", question.replace("?", " ? ") + answer])
    got = bl.leaks(df, items(spark, [(7, f"{question} {answer}")]))
    assert sorted(x["doc_id"] for x in got.collect()) == [2, 4]


def test_awkward_rows(spark):
    item = words(30, seed=77)
    long = words(40_000, seed=3) + " " + item + " " + words(10)
    df = with_clashes(documents(spark, [None, "", item, item, long, "...", words(50, seed=4)], [0, 1, 2, 2, 3, 4, None]))
    tests = items(spark, [(1, item), (1, item), (None, item), (5, None), (6, ""), (8, "!!!")]).selectExpr("*", "'x' AS number", "'y' AS words")
    got = sorted(((x["doc_id"], x["item_id"]) for x in bl.leaks(df, tests).collect()), key=repr)
    assert got == sorted([(2, 1), (2, 1), (2, None)] * 2 + [(3, 1), (3, 1), (3, None)], key=repr)
    kept = bl.without_leaks(df, tests)
    assert kept.columns == df.columns
    assert sorted((x["doc_id"] for x in kept.collect()), key=repr) == sorted([0, 1, 4, None], key=repr)


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, ["a b c"])
    assert bl.leaks(none, items(spark, [(1, "a b c")])).collect() == []
    assert bl.leaks(some, items(spark, [])).collect() == []
    assert bl.without_leaks(some, items(spark, [])).count() == 1
    assert bl.without_leaks(none, items(spark, [(1, "a b c")])).collect() == []


def test_passages_cover_every_word_run():
    counts = np.array([0, 1, 63, 64, 128, 129, 1000])
    doc, begin, end = bl.passages(counts, 128)
    base = np.cumsum(counts) - counts
    for d, n in enumerate(counts):
        spans = [(b - base[d], e - base[d]) for x, b, e in zip(doc, begin, end) if x == d]
        for at in range(n):
            size = min(64, n - at)
            assert any(b <= at and at + size <= e for b, e in spans)
