"""Randomised properties (fixed seeds; each check is one Spark job over
many inputs)."""

import random

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import corpus, state

ALPHABET = (list("abcXYZ019_-.,;:!?@#") + ["省", "市", "区", "县", "街", "路", "道", "旗", "州", "号", "北", "京"]
            + [" ", "\t", "\n", "　", " ", " ", "\x1c", "\x85", "\x0b"]
            + ["é", "ß", "Ω", "٣", "Ⅻ", "½", "😀", "​", "—", "…", "“", "”"])


def _strings(n, seed, max_len=30):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, max_len))) for _ in range(n)]


def test_clean_text_random(spark):
    """Cleaning is idempotent, leaves no white space at the ends or side by
    side, and only removes characters."""
    texts = _strings(600, 11)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    once = df.select("i", "t", T.clean_text("t").alias("c"))
    for r in once.select("*", T.clean_text("c").alias("cc")).collect():
        assert r.cc == r.c
        assert r.c == r.c.strip() and "  " not in r.c
        assert not set(r.c) - set(r.t) - {" "}
        assert sum(ch.isalnum() for ch in r.c) == sum(ch.isalnum() for ch in r.t)


def test_components_random(spark):
    """Each component is part of the text and ends in one of its markers;
    what no component took is left in the detail."""
    rnd = random.Random(5)
    parts = ["省", "市", "区", "县", "街", "路", "道", "a", "b", "1", "北京"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, cleaned_address string")
    found = 0
    for r in corpus.address_components(df).collect():
        t = texts[r.i]
        for part, marks in ((r.c_province, "省"), (r.c_city, "市州"), (r.c_district, "区县"), (r.c_street, "街道路")):
            assert part in t
            assert not part or part[-1] in marks, (t, part)
            found += bool(part)
        assert len(r.c_detail) <= len(t) and not set(r.c_detail) - set(t)
        if not (r.c_province or r.c_city or r.c_district or r.c_street):
            assert r.c_detail == t
    assert found > 100


def test_upsert_random(spark):
    rnd = random.Random(21)
    st = [(rnd.randint(0, 30), rnd.randint(0, 5), f"s{i}") for i in range(200)]
    bt = [(rnd.randint(0, 40), rnd.randint(0, 5), f"b{i}") for i in range(200)]
    s = spark.createDataFrame(st, "k int, ts int, v string").withColumn("seq", F.monotonically_increasing_id())
    b = spark.createDataFrame(bt, "k int, ts int, v string").withColumn("seq", F.monotonically_increasing_id())
    srows = [tuple(r) for r in s.collect()]
    brows = [tuple(r) for r in b.collect()]
    got = {r.k: (r.ts, r.v) for r in state.upsert(s, b, "k", ["ts", "seq"], origin_col=None).collect()}
    best = {}
    for src, rows in ((0, srows), (1, brows)):
        for k, ts, v, seq in rows:
            cand = (ts, seq, src, v)
            if k not in best or cand[:3] > best[k][:3]:
                best[k] = cand
    assert got == {k: (c[0], c[3]) for k, c in best.items()}


def test_due_keys_random(spark):
    import datetime as dt
    rnd = random.Random(33)
    now = dt.datetime(2025, 10, 3, 22, 0, 0)
    keys = [f"k{i}" for i in range(300)]
    last = {}
    for k in keys:
        c = rnd.random()
        if c < 0.2:
            continue                                            # never loaded
        if c < 0.3:
            last[k] = now - dt.timedelta(seconds=3600)          # exactly one interval
        else:
            last[k] = now - dt.timedelta(seconds=rnd.randint(0, 7200), microseconds=rnd.randint(0, 999999))
    kdf = spark.createDataFrame([(k,) for k in keys], "k string")
    ldf = spark.createDataFrame([(k, t) for k, t in last.items()], "k string, t timestamp_ntz")
    got = {r.k: (r.reason, r.due) for r in
           state.due_keys(kdf, ldf, "k", "t", F.lit(now).cast("timestamp_ntz"), 3600).collect()}
    for k in keys:
        if k not in last:
            want = ("new", True)
        elif (now - last[k]).total_seconds() >= 3600:
            want = ("stale", True)
        else:
            want = ("fresh", False)
        assert got[k] == want, (k, last.get(k))
