"""Hard negatives against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, rank string"


def brute(rows, step=50, positives=5, negatives=3):
    clean = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label, *_ in rows
             if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([v for _, _, v in clean], dtype=object)
    out = []
    for a, (i, label, _) in enumerate(clean):
        if i % step:
            continue
        score = x @ x[a]
        pos = sorted((-score[j], clean[j][0]) for j in range(len(clean)) if j != a and clean[j][1] == label)[:positives]
        for ps, p in pos:
            neg = sorted((-score[j], clean[j][0]) for j in range(len(clean))
                         if clean[j][1] != label and 50 * -ps <= 100 * score[j] <= 95 * -ps)[:negatives]
            out += [(i, p, r, n, -ps, -ns) for r, (ns, n) in enumerate(neg, 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = H.mine(df, F.col("vec_id") % 50 == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(kind, rng, n=700):
    if kind == "ties":
        return [(i, [float(x) for x in rng.integers(-3, 4, 4) / 64], int(rng.integers(0, 3)), "x") for i in range(n)]
    if kind == "hot":      # one vector that most rows share
        return [(i, [0.5, 0.25, -0.5] if i % 3 else rng.normal(size=3).tolist(), int(rng.integers(0, 4)), "x") for i in range(n)]
    if kind == "great":    # products beyond 2^53
        return [(i, (rng.normal(size=3) * 1e6).tolist(), int(rng.integers(0, 4)), "x") for i in range(300)]
    centres = rng.normal(size=(20, 16))
    return [(i, (centres[c] + rng.normal(size=16) * 0.05).tolist(), int(c % 7), "x") for i, c in enumerate(rng.integers(0, 20, n))]


@pytest.mark.parametrize("kind", ["ties", "hot", "great", "clusters"])
def test_matches_all_products(spark, kind):
    rows = vectors(kind, np.random.default_rng(2))
    dims = len(rows[0][1])
    odd = [(10_000, None, 1, "x"), (10_050, [1.0] * dims, None, "x"), (10_100, [float("nan")] * dims, 2, "x"),
           (10_150, [1.0] * (dims - 1) + [None], 2, "x"), (None, [1.0] * dims, 1, "x"), (10_200, [float("inf")] * dims, 2, "x"),
           (10_250, [0.0] * dims, 2, "x")]
    want = brute(rows + odd)
    assert want and run(spark, rows + odd) == want
    assert run(spark, rows + odd, sample=40, tile_rows=64) == want    # many tiles


def test_repeated_and_odd_rows(spark):
    rows = vectors("clusters", np.random.default_rng(5), 200)
    want = brute(rows)
    # rows again, and rows of another length; of rows with one id the smallest counts
    assert run(spark, rows + rows[:60] + [(5000 + i, [1.0], 1, "x") for i in range(50)]) == want
    assert run(spark, rows + [(i, v, 99, "x") for i, v, _, _ in rows[:60]]) == want
    assert run(spark, rows, negatives=2) == brute(rows, negatives=2)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, None, 1, "x")]) == []
    assert run(spark, [(0, [], 1, "x")]) == []
    assert run(spark, [(0, [1.0], 1, "x")]) == []          # no positive
    assert run(spark, [(0, [1.0], 1, "x"), (1, [1.0], 1, "x"), (2, [5.0], 2, "x")]) == []   # none in the window


def test_boxes_hold_their_leaves():
    rng = np.random.default_rng(7)
    x, labels = rng.integers(-9, 9, (3000, 6)).astype(float), rng.integers(0, 5, 3000)
    order, levels = H.build(x, labels)
    assert sorted(order) == list(range(3000)) and max(np.diff([*levels[0].start, 3000])) <= H.LEAF
    for k, start in enumerate(levels[0].start):
        rows = order[start:[*levels[0].start, 3000][k + 1]]
        assert (levels[0].low[k] == x[rows].min(0)).all() and (levels[0].high[k] == x[rows].max(0)).all()
        assert levels[0].labels[:, k].tolist() == [labels[rows].min(), labels[rows].max()]
    q = rng.integers(-9, 9, (50, 6)).astype(float)
    least, most = H.interval(q, levels[1].low, levels[1].high)
    assert (least.min(1) <= (q @ x.T).min(1)).all() and (most.max(1) >= (q @ x.T).max(1)).all()


def test_search_prunes_clusters():
    """Boxes outside the window or below the k-th are not looked into."""
    rng = np.random.default_rng(3)
    centres = np.round(rng.normal(size=(100, 8)) * 200)
    x = np.concatenate([c + rng.integers(-4, 5, (64, 8)) for c in centres])
    labels, ids = np.repeat(np.arange(100) % 10, 64), np.arange(6400)
    anchors = np.arange(0, 6400, 64)
    asked = H.Asked(x[anchors], ids[anchors], labels[anchors], np.arange(100), np.full(100, H.NONE), np.full(100, H.MOST),
                    np.full(100, H.NONE))
    seen = []
    H.search(x, labels, ids, asked, 5, True, True, seen)
    assert sum(seen) <= 0.1 * 100 * 6400
