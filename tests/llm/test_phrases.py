"""Phrase mining against a brute-force count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import phrases
from tidemark.llm.words import slices, table

SMALL = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "lang string, text string, rank int"


def brute(rows, least, longest=4, top=2000, contained=(100, 80)):
    counts, n = defaultdict(Counter), Counter()
    for lang, text, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                if contained[0] * a >= contained[1] * found[p[i:i + k]]}
        best = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(seed, n=300):
    """Words of unlike frequency, fixed phrases, marks and odd blanks."""
    rnd = random.Random(seed)
    words = ["the", "Of", "a", "né", "Über", "x\x1fy", "of", "rare", "zz", "Qu"] + [f"w{i}" for i in range(15)]
    fixed = ["new york city hall", "per se", "The end of", "a a a a a"]
    def one():
        parts = [rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(words[: rnd.choice([3, 10, 25])])
                 for _ in range(rnd.randrange(0, 40))]
        return "".join(p + rnd.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b", ";", " ! "]) for p in parts)
    return [(rnd.choice(["en", "de", None, "und"]), rnd.choice([None, "", one(), one(), one(), one(), one()]), 7) for _ in range(n)]


@pytest.mark.parametrize("seed,options", [
    (2, {"top": 5}), (4, {"longest": 3, "top": 12, "bands": (900_000, 400_000, 0)})])
def test_matches_brute_force(spark, seed, options):
    rows = texts(seed)
    got = phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=5, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    plain = {k: v for k, v in options.items() if k != "bands"}
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, **plain)


def test_ties_and_shared_buckets(spark, monkeypatch):
    """Many phrases of one score, cut by ``top``; two hash bits only."""
    monkeypatch.setattr(phrases, "COUNT_BITS", 2)
    monkeypatch.setattr(phrases, "FLAG_BITS", 2)
    rows = [("en", f"p{i} q{i}. ", 0) for i in range(30) for _ in range(6)] + [("en", "x y z. x y", 0)] * 6
    got = phrases.collocations(spark.createDataFrame(rows, SCHEMA), least=5, top=10, bands=(500_000, 0))
    want = brute(rows, 5, top=10)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) == 10


def test_only_promising_pairs_are_counted(spark):
    """Bounds leave out what grows from a frequent word and a rare one."""
    low, high = np.array([1000, 50, 50]), np.array([1000, 50, 50])
    at = np.array([1, 2])     # (1000, 50) and (50, 50)
    assert phrases.Pairs(500_000, None).admits(2, at, None, low, high).tolist() == [False, True]
    assert phrases.Pairs(0, 500_000).admits(2, at, None, low, high).tolist() == [True, False]


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a = 9 * 10 ** 17
    got = spark.range(1).select(phrases._score(F.lit(a), phrases._whole(F.lit(a)) + phrases._whole(F.lit(a + 1))).alias("s")).first().s
    assert got == 2_000_000 * a // (2 * a + 1)


def test_no_rows(spark):
    for rows in ([], [(None, None, 1), ("en", " . ", 1)]):
        assert phrases.collocations(spark.createDataFrame(rows, SCHEMA), bands=(0,)).isEmpty()


def test_slices_see_runs_across_cuts():
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["a", "bb", "ccc", "d\n"]) for _ in range(rnd.randrange(60))).encode() for _ in range(40)]
    to = table(b" \t", b"\n")
    whole = next(iter(slices(texts, to, carry=2)))
    want = [(int(whole.piece[i]), whole.vocabulary[int(whole.ids[i])].as_py()) for i in range(len(whole.ids))]
    got = []
    for w in slices(texts, to, carry=2, limit=50):
        assert w.number + w.fresh == len(got)
        again = [(int(w.piece[i]), w.vocabulary[int(w.ids[i])].as_py()) for i in range(len(w.ids))]
        assert again[:w.fresh] == got[w.number:]
        got += again[w.fresh:]
    assert got == want and want
