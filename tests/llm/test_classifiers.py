"""The fitted operators: held-out accuracy and defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, quality
from tidemark.llm.queries import GOOD, GRADES, grade

SF = "/root/testdata/sf0.1"
ODD = [(-1, None), (-2, ""), (-3, "123 !?"), (-4, "a"), (-5, "\x00\x01é" * 30000), (-6, None), (-6, "der die das und")]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").limit(4000).select("doc_id", "text", "lang")
    odd = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    return real.union(odd).withColumn("id", F.lit("x")).withColumn("row", F.lit(2)).cache()


def test_language_held_out_accuracy(docs):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    net = langid.fit(docs.where(~held_out), per_lang=250)
    got = {}
    for r in langid.identify(docs, net).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    true = {r.doc_id: r.lang for r in docs.where(held_out & F.col("lang").isNotNull()).collect()}
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in true)
    assert np.mean([got[i][0][0] == lang for i, lang in true.items()]) > 0.95
    assert all(0 <= s <= 1 for v in got.values() for _, s in v)
    assert [got[i] for i in (-1, -2, -3)] == [[("und", 0.0)]] * 3
    assert ("und", 0.0) in got[-6] and len(got[-6]) == 2


def test_windows_cover_the_text():
    texts = [b"", b"a" * 5, b"b" * langid.WINDOW, b"c" * (langid.WINDOW + 1)]
    codes, owner, size = langid.windows(texts)
    assert [b"".join(bytes(codes[k][:size[k]]) for k in np.flatnonzero(owner == i)) for i in range(4)] == texts
    assert (codes[:, langid.WINDOW:] == 0).all()


def test_language_without_labels(spark):
    none = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert langid.fit(none) is None
    assert [(r.lang_pred, r.score) for r in langid.identify(none, None).collect()] == [("und", 0.0)]


def test_quality_separates_grades(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = labels.where(F.col("doc_id") % 3 != 0)
    model = quality.fit(docs, learn, grade(), GRADES)
    assert (np.diff(model.thresholds) > 0).all()
    rated = quality.rate(docs, model, GOOD)
    out = rated.select("row.*", "expected_grade", "tail", "kept").collect()
    assert len(out) == docs.count() and set(out[0].asDict()) == {*docs.columns, "expected_grade", "tail", "kept"}
    by_id = {r.doc_id: r for r in out}
    held = [(r.doc_id, r.toxic, r.quality) for r in labels.where(F.col("doc_id") % 3 == 0).collect() if r.doc_id in by_id]
    kept = lambda want: np.mean([by_id[i].kept for i, t, q in held if (t, q) == want])
    assert kept((0, 1)) > 0.95
    assert kept((1, 1)) < 0.2 and kept((0, 0)) < 0.35
    # tails and expected grades follow from the same ordered probabilities
    above = model.above(np.array([0.3, -2.0]))
    assert (above[:, 0] > above[:, 1]).all()
    # a rerun learns the same weights
    assert np.array_equal(model.weights, quality.fit(docs, learn, grade(), GRADES).weights)


def test_quality_without_ratings(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, none, grade(), GRADES) is None
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, one, grade(), GRADES) is None
    out = quality.rate(docs.limit(3), None, GOOD).collect()
    assert len(out) == 3 and all(r.kept and r.tail is None for r in out)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert langid.identify(none, langid.train([b"aaa", b"bbb"], ["x", "y"])).count() == 0
    model = quality.train([quality.features("a b"), quality.features("c")], np.array([0, 1]), 2)
    assert quality.rate(none, model, 1).count() == 0


def test_scores_follow_from_the_weights(spark, docs):
    """Expected grade and tail of every row from the fitted weights, worked
    out word by word."""
    import math
    import re

    import xxhash

    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), grade(), GRADES, sample=400)
    weight = lambda s: float(model.weights[xxhash.xxh3_64_intdigest(s.encode()) % (1 << quality.BITS)])

    def shape(word):
        kinds = ["0" if c in "0123456789" else "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else c for c in word]
        return "".join(c for i, c in enumerate(kinds) if i == 0 or c != kinds[i - 1] or c == "\n")

    def tail(text):
        words = text.split()
        kinds = set(words)
        score = weight(f"r{round(2 * math.log2(max(1, len(words)) / max(1, len(kinds))))}")
        score += weight(f"t{round(20 * sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)))}")
        score += weight(f"y{round(40 * len(re.sub(r'[\w\s]', '', text)) / max(1, len(text)))}")
        for w in kinds:
            low = w.lower()
            score += weight("w" + low) + weight("p" + low[:5]) + weight("q" + low[:4])
            score += quality.SHARE / len(kinds) * (weight("e" + low[-2:]) + weight("s" + shape(w)))
        above = [1 / (1 + math.exp(-(score - t))) for t in model.thresholds]
        return sum(above), above[GOOD - 1]

    odd = spark.createDataFrame([(-9, "A" * 39 + "bbb" + "7" * 60 + "Z" * 50 + " tail")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").limit(400).union(odd)
    got = {(r.row.doc_id, r.row.text): (r.expected_grade, r.tail) for r in quality.rate(rows, model, GOOD).collect()}
    for (i, text), (expected, p) in got.items():
        want = tail(text or "")
        assert abs(expected - want[0]) < 1e-5 and abs(p - want[1]) < 1e-5, i


def test_sample_is_bounded_by_rows(spark, monkeypatch):
    """One id with many rows, some of them equal."""
    docs = spark.createDataFrame([(7, f"text {i % 300}") for i in range(900)] + [(8, "other"), (9, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, grades, n: seen.append((len(rows), sorted(grades.tolist()))) or "model")
    for parts in (1, 4):
        assert quality.fit(docs.repartition(parts), labels, grade(), GRADES, sample=200) == "model"
    assert seen[0] == seen[1] and seen[0][0] == 200
    quality.fit(docs, labels, grade(), GRADES, sample=1000)
    assert seen[-1][0] == 302
