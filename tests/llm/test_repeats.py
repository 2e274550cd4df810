from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from cases import documents, with_clashes, words

from trafficlens.llm import repeats
from trafficlens.llm.common import word_hashes


def brute(rows, window):
    """(id, text) -> (n_words, n_removed, digest), row by row."""
    ordered = [(2**63 - 1 if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, ws in ordered:
        for p in range(len(ws) - window + 1):
            key = tuple(ws[p : p + window])
            first[key] = min(first.get(key, (i, p)), (i, p))
    out = []
    for (i, ws), (doc, _) in zip(ordered, rows):
        gone = set()
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p : p + window])] < (i, p):
                gone.update(range(p, p + window))
        kept = [w for j, w in enumerate(ws) if j not in gone]
        out.append((doc, len(ws), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def found(df, **settings):
    return sorted((tuple(r) for r in repeats.count_repeats(df, **settings).collect()), key=repr)


def mixed_texts(seed, n, vocabulary):
    r = random.Random(seed)
    shared = [words(r.randrange(8, 40), seed=100 + k, vocabulary=vocabulary) for k in range(4)]
    texts = []
    for k in range(n):
        parts = [words(r.randrange(0, 30), seed=seed * 1000 + k, vocabulary=vocabulary)]
        parts += r.sample(shared, r.randrange(0, 3)) + [words(r.randrange(0, 12), seed=k, vocabulary=vocabulary)]
        texts.append(" ".join(parts))
    return texts


@pytest.mark.parametrize(("window", "anchor", "vocabulary"), [(5, 2, 3), (6, 3, 12), (20, 8, 3000), (4, 4, 4)])
def test_equals_brute_force(spark, window, anchor, vocabulary):
    texts = mixed_texts(window, 40, vocabulary)
    texts += [texts[3], texts[3], "a " * 300, "b " * 3 + "a " * 60]
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    df = documents(spark, texts, ids).repartition(5)
    assert found(df, window=window, anchor=anchor) == brute(list(zip(ids, texts)), window)


def test_awkward_rows(spark):
    long = words(30_000, seed=4, vocabulary=300)
    twice = words(30, seed=5)
    texts = [None, "", " \t\n", twice, twice, twice + " more", long, "x" * 700_000 + " " + twice, " ".join(["a"] * 40), twice]
    ids = [0, 1, 2, 3, 3, 3, 4, 5, 6, None]
    df = with_clashes(documents(spark, texts, ids))
    assert found(df) == brute(list(zip(ids, texts)), 20)
    cut = repeats.remove_repeats(df)
    assert cut.columns == df.columns
    assert cut.count() == len(texts)
    kept = {r["doc_id"]: r["text"] for r in cut.where("doc_id in (0, 1, 2, 4)").collect()}
    assert kept[0] is None and kept[1] == "" and kept[2] == " \t\n"
    assert cut.where("doc_id is null").first()["text"] == ""
    assert {r["row"] for r in cut.select("row").collect()} == {"other row"}


def test_empty_table(spark):
    df = documents(spark, [])
    assert repeats.count_repeats(df).collect() == []
    assert repeats.remove_repeats(df).columns == df.columns


def test_partition_free(spark):
    df = documents(spark, mixed_texts(9, 60, 20))
    assert found(df.repartition(1), window=6, anchor=3) == found(df.repartition(7), window=6, anchor=3)


def test_word_hashes_tell_words_apart_across_pieces():
    texts = [words(100_000, seed=2).encode(), b"", b"a\x0bb\xc2\xa0c " + b"z" * 600_000 + b" tail", b"  "]
    hashes, counts = word_hashes(texts)
    split = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(hashes) == len(split)
    seen = {}
    for w, h in zip(split, hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert np.array_equal(hashes, np.concatenate([word_hashes([w])[0] for w in texts]))


def thue_morse(length):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(length))


def test_words_built_to_collide_are_told_apart(spark):
    one = thue_morse(2048)
    other = one.translate(str.maketrans("ab", "ba"))
    hashes, _ = word_hashes([f"{one} {other} {one}".encode()])
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
    around = [f"x{i}" for i in range(25)]
    rows = [(1, " ".join([*around[:10], one, *around[10:]])), (2, " ".join([*around[:10], other, *around[10:]]))]
    df = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    assert found(df) == brute(rows, 20)


def test_word_hashes_tell_words_of_all_lengths_apart():
    r = random.Random(8)
    held = sorted({"".join(r.choices("ab\x00é", k=r.randrange(1, 40))) for _ in range(4000)} | {"a" * n for n in range(1, 60)} | {"\x00" * n for n in range(1, 30)})
    hashes, counts = word_hashes([w.encode() for w in held])
    assert counts.tolist() == [1] * len(held) and len(set(hashes.tolist())) == len(held)
    again, _ = word_hashes([" ".join(held).encode()])
    assert again.tolist() == hashes.tolist()


def test_many_equal_rows_share_their_marks(spark):
    text = words(60, seed=4)
    df = documents(spark, [text] * 400, ids=[7] * 400)
    marks = repeats.repeated_windows(df).groupBy("doc", "row").agg(repeats.F.collect_set(repeats.F.struct("start", "n")).alias("m"))
    assert sum(len(r["m"]) for r in marks.collect()) < 100
    rows = [(7, text)] * 400
    assert found(df) == brute(rows, 20)


def test_line_quoted_everywhere(spark):
    """A line shorter than a window in hundreds of surroundings: one anchor with a path per document."""
    line = words(12, seed=1, vocabulary=5000)
    texts = [f"{words(15, seed=10 + k, vocabulary=5000)} {line} {words(15, seed=900 + k, vocabulary=5000)}" for k in range(300)]
    texts += [f"{words(9, seed=7000, vocabulary=5000)} {texts[5]}", texts[8]]
    rows = list(enumerate(texts))
    got = found(documents(spark, texts).repartition(4))
    assert got == brute(rows, 20)
    assert sum(r[2] for r in got) == 84
