from __future__ import annotations

import random

import numpy as np
from cases import documents, with_clashes, words

from trafficlens.llm import order_minhash as om


def edited(text, edits, seed):
    r, ws = random.Random(seed), text.split()
    for _ in range(edits):
        at = r.randrange(len(ws))
        kind = r.randrange(3)
        if kind == 0:
            ws[at] = f"new{r.random()}"
        elif kind == 1:
            ws.insert(at, f"ins{r.random()}")
        else:
            del ws[at]
    return " ".join(ws)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], max(row[j + 1], row[j], before + 1 if x == y else 0)
    return row[-1]


def brute_classes(rows):
    nodes = [((2**63 - 1 if i is None else i), (t or "").encode()) for i, t in rows]
    sets = [om.labelled_shingles(w).astype(np.uint32) for w in om.words_by_text([t for _, t in nodes])]
    parent = list(range(len(nodes)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(nodes)):
        for j in range(i):
            if len(sets[i]) and len(sets[j]):
                common = lcs(sets[i].tolist(), sets[j].tolist())
                if common / (len(sets[i]) + len(sets[j]) - common) >= 0.8:
                    parent[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(nodes):
        least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((2**63 - 1 if i is None else i), least[top(k)]) for k, (i, _) in enumerate(rows))


def found(df):
    return sorted((r["doc"], r["class"]["doc"]) for r in om.near_duplicates(df).collect())


def test_equals_brute_force(spark):
    texts = []
    for k in range(12):
        base = words(60 + 10 * k, seed=k)
        texts += [base, base, edited(base, 1, k), edited(base, 2, k + 50), edited(base, 1 + k // 3, k + 90), edited(base, 12, k)]
    texts += ["one two", "one two", "one two three", words(80, seed=3, vocabulary=4)]
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    assert found(documents(spark, texts, ids).repartition(4)) == brute_classes(list(zip(ids, texts)))


def test_many_near_copies_of_one_text(spark):
    base = words(150, seed=8)
    texts = [base] + [edited(base, 1 + k % 5, k) for k in range(150)]
    assert found(documents(spark, texts)) == brute_classes(list(enumerate(texts)))


def test_order_matters():
    a, b = words(100, seed=1).split(), words(100, seed=2).split()
    one, two = (om.labelled_shingles(w) for w in om.words_by_text([" ".join(a + b).encode(), " ".join(b + a).encode()]))
    assert om.similarity_of(one, two) < 0.8 < len(np.intersect1d(one, two)) / len(np.union1d(one, two))


def test_aligned_is_the_longest_common_subsequence():
    r = random.Random(5)
    for k in range(60):
        a = r.sample(range(400), r.randrange(1, 80))
        b = list(a)
        for _ in range(r.randrange(8)):
            b[r.randrange(len(b))] = 1000 + r.randrange(10**6)
        if k % 3 == 0:
            r.shuffle(b)
        b = list(dict.fromkeys(b))
        true = lcs(a, b)
        got = om.similarity_of(np.array(a, np.uint32), np.array(b, np.uint32), 0.8)
        if true / (len(a) + len(b) - true) >= 0.8:
            assert abs(got - true / (len(a) + len(b) - true)) < 1e-12
        else:
            assert got < 0.8


def test_parity_never_differs_more_than_the_sets():
    r = np.random.default_rng(3)
    for n in (5, 200, 3000):
        a = r.integers(0, 2**63, n, dtype=np.uint64)
        b = np.concatenate([a[n // 10 :], r.integers(0, 2**63, 7, dtype=np.uint64)])
        differing = int(np.bitwise_count((om.parity(a) ^ om.parity(b)).view(np.uint64)).sum())
        assert differing <= len(np.setxor1d(a, b))


def test_long_text_bands_equal_those_of_one_block(monkeypatch):
    shingles = om.labelled_shingles(om.words_by_text([words(9000, seed=6).encode()])[0])
    blocked = om.bands_of(shingles)
    monkeypatch.setattr(om, "COLUMNS", 100_000)
    assert np.array_equal(blocked, om.bands_of(shingles))


def test_awkward_rows(spark):
    same = words(40, seed=9)
    long = words(20_000, seed=10)
    texts = [None, None, "", " ", same, same, same, long, edited(long, 30, 1), "single", same.replace(" ", "\n")]
    ids = [0, 1, 2, 3, 4, 4, None, 5, 6, 7, 8]
    df = with_clashes(documents(spark, texts, ids))
    got = found(df)
    assert [c for d, c in got if d in (0, 1, 2, 3, 7)] == [0, 1, 2, 3, 7]
    assert [c for d, c in got if d in (4, 8, 2**63 - 1)] == [4, 4, 4, 4]
    assert [c for d, c in got if d in (5, 6)] == [5, 5]
    kept = om.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7]


def test_empty_table(spark):
    df = documents(spark, [])
    assert om.near_duplicates(df).collect() == []
    assert om.keep_one(df).collect() == []


def test_null_ids_stay_null(spark, tmp_path):
    from cases import documents, words

    from trafficlens.llm.order_minhash import op9_order_minhash

    text = words(80, seed=1)
    documents(spark, [text, text, words(80, seed=2), None], ids=[None, 5, None, 9]).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op9_order_minhash(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(5, 5), (None, 5), (None, None), (9, 9)], key=repr)
