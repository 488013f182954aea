import random
import re

import numpy as np
import pytest

from tidemark.llm import ngram_join as J


def gram_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1))


def brute(rows, n, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, set()).add(gram_set(t, n))
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(i for i in sets if i is not None)
    for k, x in enumerate(ids):
        for y in ids[:k]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = root(x), root(y)
                up[max(a, b)] = min(a, b)
    return sorted((i is None, i or 0, len(gram_set(t, n)), None if i is None else root(i)) for i, t in rows)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "Ä"]
    rows = []
    passage = [rng.choice(vocab) for _ in range(60)]

    def add(words):
        text = rng.choice([" ", "\n", "\t "]).join(words)
        rows.append((len(rows), text.upper() if rng.random() < 0.2 and text.isascii() else text))

    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 12, 20, 40, 100, 300]))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 5, 10])):
            made = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                made[rng.randrange(len(made))] = rng.choice(vocab)
            add(made)
    chain = [rng.choice(vocab) for _ in range(120)]
    for _ in range(25):  # far ends are linked only through the others
        chain = list(chain)
        chain[rng.randrange(120)] = rng.choice(vocab)
        add(chain)
    rows += [(None, rows[0][1]), (5, "another text of a repeated id"), (5, rows[5][1]), rows[7],
             (9000, None), (9001, ""), (9002, " \n"), (9003, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,percent,rounds,block,often", [(3, 90, 2, 256, 16), (5, 80, 2, 256, 16), (3, 90, 0, 4, 3)])
def test_against_brute_force(spark, monkeypatch, n, percent, rounds, block, often):
    monkeypatch.setattr(J, "ROUNDS", rounds)
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "OFTEN", often)
    rows = corpus(n)
    df = spark.createDataFrame([(i, t, "?") for i, t in rows], "doc_id long, text string, gram string").repartition(3)
    got = [(r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in J.groups(df, n=n, percent=percent).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, n, percent), key=str)


def test_keep_one(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, None), (4, ""), (5, "x y z"), (None, "x y z")]
    df = spark.createDataFrame([(i, t, "?") for i, t in rows], "doc_id long, text string, id string")
    out = J.keep_one(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {1, 3, 4, 5, None}


def test_tree_finds_all_links():
    """Tree, bitmaps and emitted n-grams against all pairs, without Spark."""
    rng = np.random.default_rng(4)
    for percent in (50, 80, 90, 100):
        order = J.Order(rng.integers(0, 1 << 63, 20).astype(np.uint64))
        sets = []
        for _ in range(12):
            base = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 200)).astype(np.uint64))
            base = np.unique(np.concatenate([base, order.common[:rng.integers(0, 20)]]))
            for _ in range(6):
                s = base[rng.random(len(base)) > rng.choice([0, 0.01, 0.05, 0.2])]
                s = np.unique(np.concatenate([s, rng.integers(0, 1 << 63, rng.integers(0, 4)).astype(np.uint64)]))
                sets.append(order.put(s))
        sets = [s for s in {s.tobytes(): s for s in sets if len(s)}.values()]
        labels = list(range(len(sets)))
        groups = J.join_group(sets, labels, percent)
        want = J.Groups(labels)
        linked = np.zeros(len(sets), bool)
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    want.join(i, j)
                    linked[[i, j]] = True
                    assert len(np.intersect1d(J.emitted(sets[i], percent), J.emitted(sets[j], percent)))
        assert [groups.root(i) for i in labels] == [want.root(i) for i in labels]
        may = J.may_link(np.array([len(s) for s in sets]), [J.bitmap(s) for s in sets], labels, percent)
        assert not (linked & ~may).any()


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert J.groups(none).count() == 0
    assert J.keep_one(none).count() == 0
