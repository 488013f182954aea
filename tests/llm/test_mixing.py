import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import mixing


def shares(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Targets by resharing until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, free = {}, list(names)
    while free:
        rest = sum(sizes.values()) - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return stopped | share
        stopped |= {s: most * sizes[s] for s in above}
        free = [s for s in free if s not in stopped]
    return stopped


def rows(n=600):
    out = []
    for i in range(n):
        source = ["a", "a", "a", "b", "é", "Z", None, "tiny"][i % 8] if i % 40 else "tiny"
        out.append((i, "w " * (i * 7919 % 23) + ("\t\u00a0\n" if i % 5 else ""), source))
    return out + [out[3], (None, "no id here", "b"), (901, None, "a"), (902, None, "void"),
                  (903, "big " * 400, "tiny")]


def test_targets_and_takes(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("hash", F.lit(1)).repartition(3)
    got = mixing.mix(df).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += size(t)
    want = shares(sizes)
    by_id = {i: (t, s) for i, t, s in data}
    taken = defaultdict(int)
    for r in got:
        text, source = by_id[r.doc_id]
        assert r["size"] == size(text) and r.source_size == sizes[source]
        assert abs(r.target - want[source]) < 1e-6
        assert r.taken <= 3 * r["size"]
        taken[source] += r.taken
    for s in sizes:  # near: within the largest half document of the source
        most = max(size(t) for _, t, x in data if x == s)
        assert abs(taken[s] - want[s]) <= max(1, most)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df.repartition(5)).collect()))


def test_take_repeats_rows(spark):
    data = rows(200)
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = mixing.take(df)
    assert out.columns == df.columns
    rows_taken = Counter(r.doc_id for r in out.collect())
    mixed = {}
    for r in mixing.mix(df).collect():
        if r["size"]:
            mixed[r.doc_id] = mixed.get(r.doc_id, 0) + r.taken // r["size"]
    assert {i: n for i, n in rows_taken.items() if i in mixed} == {i: n for i, n in mixed.items() if n}


def test_part_of_the_rows_of_one_id(spark):
    """Equal rows, and rows of one id that differ in a column only."""
    data = [(1, "w " * 100, "a", i % 3) for i in range(600)] + [(2 + i, "v " * 50, "b", 0) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, x int")
    want = shares({"a": 60_000, "b": 20_000})
    for n in (1, 4):
        got = mixing.mix(df.repartition(n)).collect()
        taken = Counter()
        for r in got:
            assert r.taken <= 3 * r["size"]
            taken["a" if r.doc_id == 1 else "b"] += r.taken
        assert len(got) == 1000 and all(abs(taken[s] - want[s]) <= 100 for s in want) and want["a"] % 60_000
    rows_taken = Counter(r.source for r in mixing.take(df).collect())
    assert rows_taken == {"a": taken["a"] // 100, "b": taken["b"] // 50}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none).count() == 0
    assert mixing.take(none).count() == 0
