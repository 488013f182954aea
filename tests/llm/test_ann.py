import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann


def brute(rows, k, asks):
    fine = {i: np.array(v, float) for i, v in rows if v is not None and len(v) == 8 and None not in v
            and np.isfinite(v).all() and np.any(v)}
    ids = np.array(sorted(fine))
    x = np.array([fine[i] for i in ids])
    out = {}
    for q in ids[asks(ids)]:
        s = (x * fine[q]).sum(axis=1)
        keep = ids != q
        order = np.lexsort((ids[keep], -s[keep]))[:k]
        out[int(q)] = (ids[keep][order].tolist(), s[keep][order])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    out = [(i, (centres[i % 6] + 0.3 * rng.normal(size=8)).tolist()) for i in range(700)]
    out += [(1000 + i, out[3][1]) for i in range(120)]                   # one vector many times
    out += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] + [1.0] * 7), (2060, [None] + [1.0] * 7),
            (2080, [float("inf")] + [1.0] * 7), (2100, [1.0] * 5), (2120, [50.0] * 8), out[20]]
    return out


@pytest.mark.parametrize("sample,shard", [(4096, 4096), (64, 32)])
def test_factor_one_is_exact(spark, rows, sample, shard):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, id int")
    got = {}
    for r in ann.nearest(df, F.col("id") % 20 == 0, k=7, factor=1.0, sample=sample, shard_rows=shard).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(dict(rows).items(), 7, lambda i: i % 20 == 0)
    assert got.keys() == want.keys()
    for q, (ids, scores) in want.items():
        mine = sorted(got[q])
        assert [x[0] for x in mine] == list(range(1, 8))
        assert np.allclose([x[2] for x in mine], scores, rtol=0, atol=1e-12)
        assert [x[1] for x in mine] == ids


def test_recall_of_the_default(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {}
    for r in ann.nearest(table, F.col("id") % 20 == 0, shard_rows=64).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    p = table.toPandas()
    x = np.array(p.embedding.tolist(), float)
    ids = p.vec_id.to_numpy()
    hits = 0
    for q in got:
        s = x @ x[ids == q][0]
        hits += len(got[q] & set(ids[ids != q][np.argsort(-s[ids != q])[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(two, F.lit(True)).collect()) == [
        (1, 1, 2, 0.0), (2, 1, 1, 0.0)]


def test_norms_of_any_spread(spark):
    """One vector of 50 times the length, then norms over several octaves."""
    x = np.array(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas().embedding.tolist(), float)
    rng = np.random.default_rng(3)
    outlier = x.copy()
    outlier[7] *= 50
    for y in (outlier, x * np.exp(rng.normal(size=len(x)))[:, None]):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "vec_id long, embedding array<double>")
        got = {}
        for r in ann.nearest(df, F.col("id") % 20 == 0, shard_rows=256).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        assert sorted(got) == list(range(0, len(y), 20)) and {len(v) for v in got.values()} == {20}
        hits = 0
        for q in got:
            s = y @ y[q]
            s[q] = -np.inf
            hits += len(got[q] & set(np.argsort(-s)[:20].tolist()))
        print("recall", hits / (20 * len(got)))
        assert hits >= 0.95 * 20 * len(got)


def test_share_looked_at_on_clusters():
    """Figures of the README: pairs that no bound leaves out, and recall."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(200, 64))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    x = centres[rng.integers(0, 200, 8000)] + rng.normal(size=(8000, 64)) * 0.02
    asks = np.arange(0, 8000, 20)
    q = x[asks] / np.linalg.norm(x[asks], axis=1)[:, None]
    seen, s = [], q @ x.T
    ids, _ = ann.search(ann._lift(x, np.linalg.norm(x, axis=1).max()), ann._lift_query(q), 21, ann.FACTOR, np.full(400, np.inf), seen)
    s[np.arange(400), asks] = -np.inf
    best = np.argsort(-s, axis=1)[:, :20]
    recall = np.mean([len({*a[a != j][:20]} & {*b}) / 20 for a, b, j in zip(ids, best, asks)])
    assert recall >= 0.95 and sum(seen) <= 0.4 * 400 * 8000
