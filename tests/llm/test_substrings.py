"""Substring dedup against a brute-force count of all windows."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import substrings


def brute(texts, least):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    count = Counter(tuple(w[i:i + least]) for w in words for i in range(len(w) - least + 1))
    out = []
    for w in words:
        gone = {i + j for i in range(len(w) - least + 1) if count[tuple(w[i:i + least])] > 1 for j in range(least)}
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def run(spark, texts, least, parts=3):
    rows = [(i, t, "k", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string, `key.b` string, n_words long").repartition(parts)
    out = substrings.drop_repeats(df, least=least)
    assert out.columns == ["row", "n_words", "n_removed", "kept"] and out.schema["row"].dataType.names == ["id", "key.b", "n_words"]
    got = {r.id: (r.n_words, r.n_removed, r.kept) for r in out.select("row.id", "n_words", "n_removed", "kept").collect()}
    return [got[i] for i in range(len(texts))]


def some_texts(seed):
    rnd = random.Random(seed)
    return [None, "", " \n ", "one two", "x " * 60, "x " * 60, "x " * 7, "x y z"] + [
        "".join(rnd.choice("abcé") + rnd.choice(["", "1"]) + rnd.choice([" ", "\t", "\r\n", "  "]) for _ in range(rnd.randrange(70)))
        for _ in range(60)]


@pytest.mark.parametrize("least,limit", [(3, 8 << 20), (4, 40), (5, 64), (9, 90)])
def test_matches_brute_force(spark, monkeypatch, least, limit):
    """Also in slices so small that windows cross the cuts."""
    monkeypatch.setattr(substrings.slices, "__defaults__", (limit,))
    texts = some_texts(least)
    assert run(spark, texts, least) == brute(texts, least)


def test_passages_in_unlike_texts(spark):
    """Passages of 34 words stay, those of 35 and more go, wherever they are;
    several joins (no broadcasts) give the same."""
    rnd = random.Random(8)
    fresh = lambda n: " ".join(f"w{rnd.randrange(10 ** 9)}" for _ in range(n))
    passages = [fresh(n) for n in (34, 35, 36, 120, 400)]
    texts = [" ".join([fresh(50), p, fresh(rnd.randrange(30))]) for p in passages for _ in range(2)]
    texts += [passages[3] + " " + fresh(3) + " " + passages[3], fresh(300), passages[4]]
    want = brute(texts, 35)
    assert [w[1] for w in want[:6]] == [0, 0, 35, 35, 36, 36]
    assert run(spark, texts, 35) == want
    limit = substrings.BROADCAST_KEYS
    try:
        substrings.BROADCAST_KEYS = 0
        assert run(spark, texts, 35) == want
    finally:
        substrings.BROADCAST_KEYS = limit


def test_group_of_copies(spark):
    texts = [" ".join(f"t{i}" for i in range(60))] * 200 + ["short text"] * 3
    assert run(spark, texts, 35) == [(60, 60, "")] * 200 + [(2, 0, "short text")] * 3


def test_levels():
    assert substrings.lengths(35) == [9, 18, 35] and substrings.lengths(3) == [2, 3] and substrings.lengths(4) == [2, 4]


def test_no_rows_and_short_windows(spark):
    assert substrings.drop_repeats(spark.createDataFrame([], "id long, text string")).isEmpty()
    with pytest.raises(ValueError):
        substrings.drop_repeats(spark.createDataFrame([], "id long, text string"), least=2)
