from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from trafficlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab) for i, v, lab in rows], SCHEMA)


def brute(rows, every=100, positives=5, negatives=10):
    """Counted result rows, straight from the contract."""
    held = []
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((i, [math.floor(256 * float(x)) for x in v], lab))
    out = Counter()
    for a, (i, q, lab) in enumerate(held):
        if i % every:
            continue
        others = [(sum(x * y for x, y in zip(q, p)), j, other) for b, (j, p, other) in enumerate(held) if b != a and len(p) == len(q)]
        others.sort(key=lambda x: (-x[0], x[1]))
        for s, p, _ in [x for x in others if x[2] == lab][:positives]:
            fits = [(n, m) for n, m, other in others if other != lab and 30 * s <= 100 * n <= 90 * s]
            for rank, (n, m) in enumerate(fits[:negatives], 1):
                out[i, p, rank, m, s, n] += 1
    return out


def mined(df, **options):
    return Counter(tuple(r) for r in hn.mine(df, **options).collect())


def clustered(n, dim, seed=0, spread=0.2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dim)) / np.sqrt(dim)
    return [(i, (centres[i % 12] + spread * r.normal(size=dim) / np.sqrt(dim)).tolist(), int(r.integers(4))) for i in range(n)]


def test_defaults_against_brute_force(spark):
    rows = clustered(1500, 24)
    want = brute(rows)
    assert want
    assert mined(frame(spark, rows).repartition(6)) == want


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"FANOUT": 4, "CELL_ROWS": 40, "LEAF_ROWS": 20, "GROUP_ROWS": 64, "QUERY_ROWS": 3, "SAMPLE_ROWS": 200}.items():
        monkeypatch.setattr(hn, name, value)


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_deep_tree_and_both_joins(spark, small_blocks, monkeypatch, limit):
    monkeypatch.setattr(hn, "BROADCAST_BYTES", limit)
    rows = clustered(900, 8, seed=1)
    # A third of the rows are copies of one vector; ids repeat; a second vector length.
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(450)] + [(100, rows[5][1], 1)] * 3 + [(200, rows[0][1], rows[0][2])] * 2
    rows += [(5000 + i, [0.1 * i, 1.0, -0.5], i % 2) for i in range(150)]
    assert mined(frame(spark, rows).repartition(5), every=50) == brute(rows, every=50)


def test_same_result_however_rows_are_dealt(spark, small_blocks):
    df = frame(spark, clustered(700, 6, seed=2))
    assert mined(df.repartition(1)) == mined(df.repartition(9)) != Counter()


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0], 1), (1, [1, 0], 1), (2, [0.5, 0], 2), (3, None, 1), (4, [nan, 1], 1), (5, [inf, 1], 2), (6, [None, 1], 1), (7, [0.9, 0], None),
            (None, [1, 0], 1), (8, [], 1), (100, [], 1), (101, [], 2), (9, [1e300, 0], 2), (200, [0, 0], 1), (201, [0, 1], 2), (300, [-1, 0], 3), (301, [1, 0], 3)]
    df = frame(spark, rows).selectExpr("*", "1 AS q", "'x' AS row", "'y' AS id", "0 AS part", "0 AS dim")
    # The vector beyond the bound takes no part; scores of empty vectors are zero.
    assert mined(df) == brute([r for r in rows if r[0] != 9])
    assert mined(frame(spark, [])) == Counter()
    assert mined(frame(spark, [(1, [1.0], 1)])) == Counter()


def test_scores_beyond_the_exact_doubles_are_exact():
    x = np.array([[2**28, 2**28 - 1, 3]], np.int64)
    assert hn.scores(x, x)[0, 0] == 2**56 + (2**28 - 1) ** 2 + 9


def test_tree_leaves_out_most_cells_of_clustered_vectors():
    x = np.array([[math.floor(256 * e) for e in v] for _, v, _ in clustered(4000, 16, seed=3, spread=0.05)], np.int64)
    tree = hn.grow(x, 2)
    cells = hn.cells_of(tree, x)
    spans = {}
    for c in np.unique(cells):
        low, high = hn.ranges(tree, int(c), x[cells == c])
        spans[int(c)] = low, high
    flat = [(16, c, i, lo, hi) for c, (low, high) in spans.items() for i, (lo, hi) in enumerate(zip(low, high))]
    import pyarrow as pa

    known = hn._subtrees({16: tree}, pa.table(dict(zip(("dim", "cell", "pos", "low", "high"), map(list, zip(*flat))))))[16]
    a = x[:50]
    top = np.sort(hn.scores(x, a), axis=0)
    low, high = top[-20], np.full(50, hn.HIGHEST)
    packed = {"dim": 16, "rows": np.arange(50), "labels": np.zeros(50, np.int64), "vectors": a, "owner": np.arange(50), "part": np.zeros(50, np.int64), "low": low, "high": high}
    asked = hn.Queries({k: v if isinstance(v, int) else v.astype(np.int64).tobytes() for k, v in packed.items()}, 5, False)
    alive = asked.cells(tree, known)
    # No cell that holds a row of the window is left out, and most others are.
    held = hn.scores(x, a) >= low[None, :]
    for j in range(50):
        assert alive[j, np.unique(cells[held[:, j]])].all()
    assert alive[:, np.unique(cells)].mean() < 0.5


def test_query_on_given_rows(spark, folder):
    rows = [(r["vec_id"], r["embedding"], None if r["label"] is None else (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in hn.op11_hard_negatives(spark, folder).collect()) == brute(rows)
