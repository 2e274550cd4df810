from __future__ import annotations

import random
from itertools import accumulate

import pytest
from cases import documents, with_clashes, words
from pyspark.sql import functions as F

from trafficlens.llm import token_counts as tc


@pytest.fixture(scope="module")
def counter():
    with open(tc.TOKENIZER, "rb") as file:
        return tc.Counter(file.read())


def whole(counter, text):
    return len(counter.encode(text))


ALPHABET = "ab é1 2\n\t  .,'s't'll!?ß中"


def noise(r, n):
    return "".join(r.choice(ALPHABET) for _ in range(n))


@pytest.mark.parametrize("leaf", [1, 2, 5, 32])
def test_any_edit_gives_the_count_of_the_whole_text(counter, monkeypatch, leaf):
    monkeypatch.setattr(tc, "LEAF", leaf)
    r = random.Random(leaf)
    for _ in range(40):
        text = noise(r, r.randrange(0, 300))
        tree = tc.Tree(text, *counter.leaves(text), counter)
        for _ in range(12):
            at, removed = r.randrange(-3, len(tree.text) + 5), r.choice([0, 0, 1, 2, 30, 400])
            inserted = noise(r, r.choice([0, 0, 1, 2, 40, 300]))
            begin = min(max(at, 0), len(tree.text))
            want = tree.text[:begin] + inserted + tree.text[begin + removed :]
            tree.edit(at, removed, inserted)
            assert tree.text == want
            assert tree.total == whole(counter, want)
            chars, tokens = tree.leaves()
            assert sum(chars) == len(want) and sum(tokens) == tree.total
            # Leaves begin and end where the whole text is cut.
            pieces = counter.cut.findall(want)
            ends = [0, *accumulate(map(len, pieces))]
            at = 0
            for c, t in zip(chars, tokens):
                assert sum(counter[p] for p in pieces[ends.index(at) : ends.index(at + c)]) == t
                at += c


def test_edits_of_a_long_text_touch_little(counter):
    text = words(60_000, seed=1)
    tree = tc.Tree(text, *counter.leaves(text), counter)
    for k in range(50):
        tree.edit((k * 7919) % len(text), 3, "new words")
    assert tree.total == whole(counter, tree.text)
    assert tree.encoded < 50 * 3 * tc.LEAF


def test_table_of_edits(spark, counter):
    texts = {i: words(30 + i, seed=i) for i in range(20)}
    state = tc.count_tokens(documents(spark, list(texts.values())))
    rows, r = [], random.Random(3)
    for i in range(0, 20, 2):
        for seq in range(3):
            rows.append((i, seq, r.randrange(100), r.randrange(6), noise(r, 5)))
    edits = spark.createDataFrame(rows, "doc_id long, seq int, at int, removed int, inserted string")
    done = tc.apply_edits(tc.gather_edits(state, edits.repartition(5)))
    for i, _, at, removed, inserted in sorted(rows, key=lambda x: x[:2]):
        at = min(at, len(texts[i]))
        texts[i] = texts[i][:at] + inserted + texts[i][at + removed :]
    for x in done.collect():
        assert x["text"] == texts[x["doc_id"]] and x["n_tokens"] == whole(counter, x["text"])
        assert (x["n_encoded"] > 0) == (x["doc_id"] % 2 == 0)
    # The new state takes further edits.
    more = tc.apply_edits(done.withColumn("edits", F.expr("array(named_struct('at', 5, 'removed', 2, 'inserted', 'x y'))")))
    assert all(x["n_tokens"] == whole(counter, x["text"]) for x in more.collect())


def test_edits_of_null_ids_and_clashing_names(spark, counter):
    texts = ["one two", "three", "four five", None]
    state = with_clashes(tc.count_tokens(documents(spark, texts, [1, None, 2, None])))
    state = state.withColumns({"_key": F.lit("other"), "_steps": F.lit("other"), "_listed": F.lit("other"), "edits": F.lit("old")})
    rows = [(None, 2, 0, 0, "b"), (None, 1, 0, 0, "a"), (2, 1, 0, 4, "six"), (2, 1, 0, 0, ""), (9, 1, 0, 1, "lost")]
    edits = spark.createDataFrame(rows, "doc_id long, seq int, at int, removed int, inserted string")
    gathered = tc.gather_edits(state, edits)
    assert gathered.columns == [c for c in state.columns if c != "edits"] + ["edits"]
    done = tc.apply_edits(gathered).collect()
    assert sorted(x["text"] for x in done) == ["ba", "bathree", "one two", "six five"]
    assert all(x["n_tokens"] == whole(counter, x["text"]) and x["_listed"] == "other" for x in done)
    empty = tc.gather_edits(state.limit(0), edits.limit(0))
    assert empty.count() == 0


def test_query_counts_whole_texts(spark, folder, counter):
    texts = {r["doc_id"]: (r["text"], r["e"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", tc.revisions(F.col("text")).alias("e")).collect()}
    rows = tc.op3_token_counts(spark, folder).collect()
    assert len(rows) == len(texts)
    for x in rows:
        text, edits = texts[x["doc_id"]]
        assert x["n_tokens"] == whole(counter, text)
        for e in edits:
            text = text[: e["at"]] + e["inserted"] + text[e["at"] + e["removed"] :]
        assert x["n_tokens_edited"] == whole(counter, text)


def test_awkward_rows(spark, counter):
    texts = [None, "", "<|endoftext|>", "same", "same", " " * 50_000, "x" * 20_000]
    df = with_clashes(documents(spark, texts, [0, 1, 2, 3, 3, 4, None]))
    state = tc.count_tokens(df)
    assert sorted(x["n_tokens"] for x in state.collect()) == sorted(whole(counter, t or "") for t in texts)
    edits = "array(null, named_struct('at', cast(null as int), 'removed', 1, 'inserted', cast(null as string)), named_struct('at', 1, 'removed', 0, 'inserted', 'q'))"
    done = tc.apply_edits(state.withColumn("edits", F.expr(f"if(doc_id = 1, null, {edits})"))).collect()
    assert len(done) == 7 and all(x["n_tokens"] == whole(counter, x["text"]) for x in done)
    assert {x["text"] for x in done if x["doc_id"] in (0, 1)} == {"q", ""}
    assert {x["score"] for x in done} == {"other score"}


def test_empty_table(spark):
    state = tc.count_tokens(documents(spark, []))
    assert state.collect() == []
    assert tc.apply_edits(state.withColumn("edits", F.lit(None))).collect() == []
