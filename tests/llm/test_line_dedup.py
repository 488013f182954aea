import random
import re
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import line_dedup as L
from tidemark.llm.queries import op7_line_dedup

NO_DIGITS = str.maketrans("0123456789", "ghijklmnop")


def masked(line):
    return re.sub(r"[\t-\r ]+", " ", re.sub(r"[^\t-\r ]*[0-9][^\t-\r ]*", "<*>", line)).strip(" ")


def brute(rows, min_docs):
    docs, leaf, lines = defaultdict(set), defaultdict(set), Counter()
    for i, t in rows:
        for line in [] if t is None else t.split("\n"):
            if m := masked(line):
                docs[m].add((i, t))
                lines[m] += 1
                leaf[len(m.split(" ")), tuple(m.split(" ")[:3])].add(m)
    drop = {m for m in docs if len(docs[m]) >= min_docs}
    for (n, _), found in leaf.items():
        if n < L.MIN_TOKENS or len(found) < 2 or sum(len(docs[m]) for m in found) < min_docs:
            continue
        template = []
        for p in range(n):
            votes = Counter()
            for m in found:
                votes[m.split(" ")[p]] += lines[m]
            template.append(max(votes.items(), key=lambda x: (x[1], x[0].encode()))[0])
        like = [m for m in found if sum(a == b for a, b in zip(m.split(" "), template)) >= L.SIMILAR * n]
        if like and len(set().union(*(docs[m] for m in like))) >= min_docs:
            drop |= set(like)
    out = Counter()
    for i, t in rows:
        old = [] if t is None else t.split("\n")
        new = [x for x in old if masked(x) not in drop]
        out[i, t if t is None else "\n".join(new), len(old), len(old) - len(new)] += 1
    return out, drop


def test_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    rows += [(9001, None), (9002, ""), (9003, "a\n\nb"), (9007, "user 5 logged in from host beta at dusk today"),
             (9004, "user 12 logged in from host 1.2.3.4 at noon today\nx"), (None, "user 1 logged in from host h at noon today"),
             (9005, "user 77 logged in from host 9.2.3.4 at noon today"), (9006, "user 5 logged in from host alpha at noon today\n\n"),
             (9007, "user 5 logged in from host beta at dusk today"), (9008, "word " * 20000 + "\n" * 500)]
    df = spark.createDataFrame([(i, t, "?", 0) for i, t in rows], "doc_id long, text string, line string, pos int").repartition(3)
    out = L.drop_recurring(df)
    assert out.columns == [*df.columns, "_lines", "_dropped"]
    want, drop = brute(rows, L.MIN_DOCS)
    assert any(d.startswith("user <*> logged in") for d in drop)
    assert Counter((r.doc_id, r.text, r["_lines"], r["_dropped"]) for r in out.collect()) == want


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = L.drop_recurring(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert L.drop_recurring(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def kept(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in L.drop_recurring(df, **more).orderBy("doc_id").collect()]


def test_lines_of_fields_are_compared_as_they_are(spark):
    table = [f"{i} {i + 1} {i * i} {i + 7}\n19{60 + i}\nid-{i}\n今天有{i}个人去了北京的{'商场公园车站'[2 * i:2 * i + 2]}\nrow {i} {i + 5} {i}"
             for i in range(3)]
    assert kept(spark, table) == table
    # equal ones recur, and so do words around a field
    same = ["7 8  9\nPage 1 of 5\n第1章 今天", "7 8 9\nPage 2 of 5\n第2章 今天", "7 8 9\nPage 3 of 5\n第33章 今天"]
    assert kept(spark, same) == ["", "", ""]


def test_long_lines_of_two_documents(spark, tmp_path):
    words = "the quick brown fox jumps over a lazy dog and"
    passage, short = " ".join([words] * 6), " ".join([words] * 4)
    unspaced = "".join(chr(0x4E00 + i) for i in range(120))
    texts = [f"alpha\n{passage}\n{short}\n{unspaced}", f"beta\n{short}\n{passage}\n{unspaced}", "gamma " * 70]
    assert kept(spark, texts, long_docs=L.LONG_DOCS) == [f"alpha\n{short}", f"beta\n{short}", texts[2]]
    assert kept(spark, texts) == texts
    # and the query asks for them
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.doc_id, r.n_dropped) for r in op7_line_dedup(spark, str(tmp_path)).collect()) == [
        (0, 2), (1, 2), (2, 0)]


def test_several_templates_of_a_leaf(spark):
    """Two templates share length and path; short lines have one too."""
    name = "ada ben cy dot eva fay gus hal ivy jon".split()
    big = [f"please note that {n} has left a comment under your post" for n in name]
    small = [f"please note that our office in {n} stays closed on monday" for n in name[:4]]
    alone = ["please note that nobody here knew why it rained so much", "please note that seven geese flew over an empty green field"]
    short = [f"posted by user {n} today" for n in name[:3]]
    texts = [f"{a}\nown words {n}" for a, n in zip(big, name)] + [f"{a}\nmore {b}" for a, b in zip(small, name)] + alone
    texts += short + ["posted by user and deleted"]
    got = kept(spark, texts)
    assert got == [f"own words {n}" for n in name] + [f"more {n}" for n in name[:4]] + alone + [""] * 3 + texts[-1:]


def test_many_lines_of_one_path(spark):
    """A small template among many lines of its path."""
    pool = [f"{x}{y}" for x in "bcdfghjkl" for y in "aeiou"]
    lone = ["we say that {} {} {} {} {} at last".format(*(pool[(7 * i + j * (i + 3)) % 45] + "n" * (i % 3) for j in range(5)))
            for i in range(40)]
    same = [f"we say that all rivers run {pool[i]} down at last" for i in range(3)]
    got = kept(spark, lone + same)
    assert got[40:] == [""] * 3
    agree = lambda x, y: sum(a == b for a, b in zip(x.split(), y.split()))
    for line, left in zip(lone, got):
        near = {x for x in lone + same if agree(line, x) >= 7}
        assert left == line or len(near) > 1
        assert left == "" or len(near) < 3


def patterned(rows, min_docs):
    """The lines of ``rows`` (document, line) that the rule for patterns
    finds, where all lines have one length and path."""
    docs = defaultdict(set)
    for d, line in rows:
        docs[line].add(d)
    n = len(rows[0][1].split(" "))
    need = -(-L.SIMILAR * n // 1) if n >= L.MIN_TOKENS else -(-L.SHORT_SIMILAR * n // 1)
    support = Counter()
    for line, ds in docs.items():
        for p, token in enumerate(line.split(" ")):
            support[p, token] += len(ds)
    groups = defaultdict(set)
    for line in docs:
        tokens, least = line.split(" "), min_docs
        while least <= max(support[p, t] for p, t in enumerate(tokens)):
            shape = tuple(t if support[p, t] >= least else "<*>" for p, t in enumerate(tokens))
            if sum(support[p, t] >= least for p, t in enumerate(tokens)) >= need:
                groups[shape].add(line)
            least *= L.STEP
    return {x for g in groups.values() if len(g) > 1 and len(set().union(*(docs[x] for x in g))) >= min_docs for x in g}


def test_patterns_against_brute_force(spark):
    rnd = random.Random(6)
    word = lambda k: "w" + "abcdefghij"[rnd.randrange(10)] * rnd.randrange(1, k)
    shapes = ["x y z one two three {} four five {}", "x y z {} {} seven eight nine ten up", "x y z {} {} {} {} {} {} {}"]
    rows = [(i // 2, rnd.choice(shapes).format(*(word(rnd.choice([2, 9])) for _ in range(7)))) for i in range(300)]
    df = spark.createDataFrame([(d, "\n".join(x for dd, x in rows if dd == d)) for d in range(150)], "doc_id long, text string")
    lines = L._lines(df, "doc_id", "text")
    counted = lines.groupBy("leaf", "a", "b", "n", "long", "k1", "k2").agg(F.lit(1)).groupBy("leaf", "a", "b", "n", "long").agg(
        F.count("*").alias("docs"))
    wide = counted.select("leaf").distinct()
    held = L._tokens(df, lines, wide, "doc_id", "text").join(counted.select("a", "b", "docs"), ["a", "b"])
    got = L._patterned(lines, held, 3).join(held.select("a", "b", "tokens"), ["a", "b"]).distinct()
    assert {" ".join(r.tokens) for r in got.collect()} == patterned(rows, 3)
    assert patterned(rows, 3)


def test_cost_of_lines_of_one_path(spark):
    """No step pairs the lines of a path: twice the lines are about twice
    the rows of every step."""
    rnd = random.Random(2)
    lines = lambda n: [" ".join(["we", "say", "that", *(f"q{rnd.randrange(10 ** 6):x}z".translate(NO_DIGITS) for _ in range(7)), "end"])
                       for _ in range(n)]
    took = []
    for n in (1000, 4000):
        texts = lines(n)
        start = time.time()
        assert kept(spark, texts) == texts
        took.append(time.time() - start)
    assert took[1] < 3 * took[0] + 5


def test_hashes_do_not_follow_from_each_other(spark):
    """Equal first hashes say nothing of the second one."""
    df = spark.range(200_000).select(*L._hashes("a", "b", "id"))
    masks = df.select((F.col("a") % 1024).alias("a"), (F.col("b") % 1024).alias("b")).distinct()
    assert masks.count() > 150_000


def test_simpler_patterns_say_the_same(spark):
    """Lines without unspaced scripts, masked and counted by both patterns."""
    rnd = random.Random(11)
    lines = ["".join(rnd.choice("abZé09 \t-.,ßж()") for _ in range(rnd.randrange(30))) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    plain = [tuple(r) for r in df.select(L._masked(F.col("line")), L._literal(L._masked(F.col("line")))).collect()]
    spaced = L._spaced
    try:
        L._spaced = lambda line: F.lit(False)
        assert plain == [tuple(r) for r in df.select(L._masked(F.col("line")), L._literal(L._masked(F.col("line")))).collect()]
    finally:
        L._spaced = spaced
