from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from cases import SCHEMA, crc_rest, documents, with_clashes

from trafficlens.llm import toxicity as tx
from trafficlens.llm.queries import QUERIES

PLAIN = "you are such a fool and this is a lovely rotten morning for everyone stupid moron idiot garbage people walking little street".split()


@pytest.fixture(scope="module")
def model():
    grams = Counter()
    for w in PLAIN * 5:
        padded = f"^^{w}$"
        grams.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return tx.CharModel(grams)


@pytest.mark.parametrize(("text", "restored"), [
    ("you m0r0n", "you moron"), ("1d1ot!", "idiot"), ("$tupid p3ople", "stupid people"), ("s t u p i d", "stupid"),
    ("what i d i o t s t r e e t", "what idiot street"), ("stuuuupid", "stupid"), ("m-o-r-o-n.", "moron"), ("g@rb@ge", "garbage"),
    ("st*pid", "stupid"), ("this is a morning", "this is a morning"), ("little street", "little street"), ("THE END!!", "the end"), ("403 12:30", "403 12:30"),
])
def test_restores(model, text, restored):
    assert " ".join(tx.restore(text.encode(), tx.Restorer(model))) == restored


def brute_decode(span, model):
    best = None
    for path in itertools.product(*tx.lattice(span)):
        cost, state, out, ok = 0.0, "^^", "", True
        for c, price in path:
            cost += price
            if c == " ":
                if state == "^^":
                    ok = False
                    break
                cost, state = cost + model.cost(state + "$"), "^^"
            elif c:
                cost, state = cost + model.cost(state + tx.letter(c)), state[1] + tx.letter(c)
            out += c
        if ok:
            cost += model.cost(state + "$") if state != "^^" else 0.0
            if best is None or cost < best[0] - 1e-9:
                best = (cost, out.strip())
    return best


def test_viterbi_finds_the_cheapest_path(model):
    r = random.Random(3)
    for _ in range(60):
        span = "".join(r.choice("abdimnost013!$@| -o") for _ in range(r.randrange(1, 7)))
        want = brute_decode(span, model)
        got = tx.decode(span, model)
        # Equal costs may belong to different words.
        assert got == want[1] or abs(_cost_of(span, got, model) - want[0]) < 1e-6


def _cost_of(span, word, model):
    costs = []
    for path in itertools.product(*tx.lattice(span)):
        if "".join(c for c, _ in path).strip() != word:
            continue
        cost, state = 0.0, "^^"
        for c, price in path:
            cost += price
            if c == " ":
                cost, state = cost + model.cost(state + "$"), "^^"
            elif c:
                cost, state = cost + model.cost(state + tx.letter(c)), state[1] + tx.letter(c)
        costs.append(cost + (model.cost(state + "$") if state != "^^" else 0.0))
    return min(costs)


def test_letter_counts_cover_all_documents(spark):
    texts = ["Ab ab, x1", None, "ab", "ж— ab", "don't\nŒuvre ʼ a", ""]
    grams = Counter()
    for w in ["ab", "ab", "x", "ab", "ж", "ab", "don", "t", "œuvre", "ʼ", "a"]:
        padded = "^^" + "".join(map(tx.letter, w)) + "$"
        grams.update(padded[i : i + 3] for i in range(len(padded) - 2))
    assert tx.char_model(documents(spark, texts).repartition(3)).tri == grams


def auc(truth, scores):
    rank = pd.Series(scores).rank().to_numpy()
    truth = np.array(truth) == 1
    return (rank[truth].sum() - truth.sum() * (truth.sum() + 1) / 2) / (truth.sum() * (~truth).sum())


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity"](spark, folder).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (crc_rest(r["doc_id"], 4) == 2) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    kept = [(labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert auc(*zip(*kept)) > 0.85


def labelled(spark, n):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        ws = [r.choice(PLAIN[:5] + PLAIN[6:10]) for _ in range(20)] + (["moron", "idiot"] if bad else [])
        rows.append((i, " ".join(ws), "en", "s", 0))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_and_restored_words(spark):
    docs, labels = labelled(spark, 240)
    model = tx.fit(docs, labels)
    score = model.scorer()
    assert score(b"you m0r0n") > 0.5 > score(b"you lovely fool") and score(b"") < 0.3
    # Labels of held-out rows must not matter.
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic) AS toxic")
    assert tx.fit(docs, flipped).scorer()(b"you m0r0n") == score(b"you m0r0n")


def test_awkward_rows(spark):
    docs, labels = labelled(spark, 120)
    model = tx.fit(docs.unionByName(documents(spark, [None, "", "x"], [None, 2000, None])), labels.union(spark.createDataFrame([(3, None), (None, 1), (3, 1)], labels.schema)))
    df = with_clashes(documents(spark, [None, "", "moron", "moron", "a" * 300_000, "moron " * 50_000], [0, 1, 2, 2, None, 3]))
    scored = tx.score(df, model, name="score")
    assert scored.columns == [c for c in df.columns if c != "score"] + ["score"]
    got = scored.collect()
    assert len(got) == 6 and len({r["score"] for r in got if r["doc_id"] in (0, 1)}) == 1
    assert {r["size"] for r in got} == {"other size"}


def test_without_both_classes_or_rows(spark):
    docs, labels = labelled(spark, 40)
    for known in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.where("false")):
        scores = {r["score"] for r in tx.score(docs, tx.fit(docs, known)).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1
    none = documents(spark, [])
    assert tx.score(none, tx.fit(none, labels)).collect() == []
