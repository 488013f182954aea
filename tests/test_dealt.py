"""What is de-duplicated is dealt out first: no task holds all distinct rows
of the split that it read, or a share that grows with the table."""

import random

from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.operators import analytics, corpus, encode

ADDRESS = "cleaned_address string, province string, city string, district string, street string"


def dealt_first(df):
    """The aggregate nearest to the scan lies above an exchange by hash."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    last = max(i for i, line in enumerate(plan) if "Aggregate(" in line)
    return any("Exchange hashpartitioning" in line for line in plan[last + 1:])


def addresses(spark):
    rows = [(f"湖北省武汉市武昌区东湖路{i % 40}号", "湖北省", "武汉市", "武昌区", "东湖路" if i % 3 else None) for i in range(200)]
    return spark.createDataFrame(rows + [(None, "京", "京省", "京", "未知"), (None, "京", "京省", "京", "未知")], ADDRESS)


def rule_pairs(rows):
    known = lambda x: x not in (None, "", fixed.UNKNOWN)
    asked = lambda q, a: None if a is None else q + a
    out = set()
    for a, p, c, d, s in rows:
        standard = "".join(x for x in (p, c, d, s) if known(x))
        for there, q, answer in ((known(p), fixed.Q_PROVINCE, f"{fixed.A_PREFIX}{p}{fixed.A_PROVINCE_SUFFIX}"),
                                 (known(c), fixed.Q_CITY, f"{fixed.A_PREFIX}{c}"),
                                 (known(d), fixed.Q_DISTRICT, f"{fixed.A_PREFIX}{d}"),
                                 (standard != "", fixed.Q_STANDARD, fixed.A_STANDARD + standard)):
            if there:
                out.add((asked(q, a), answer, a, p, c, d, s))
    return out


def test_rule_pairs_dealt(spark):
    """Also two equal pairs of one row, which a NULL address makes."""
    df = addresses(spark)
    pairs = corpus.qa_pairs_rule(df)
    assert dealt_first(pairs)
    got = [tuple(r) for r in pairs.collect()]
    want = rule_pairs([tuple(r) for r in df.collect()])
    assert len(got) == len(want) and set(got) == want
    assert sum(r[0] is None for r in got) == 3  # province and city give the same pair


def test_encoded_pairs_dealt(spark):
    df = addresses(spark)
    e = encode.encode_pairs(corpus.qa_pairs_rule(df), fixed.MAX_LENGTH, keep=("instruction", "output"))
    assert dealt_first(e)
    want = sorted((r[0] or "", r[1]) for r in rule_pairs([tuple(r) for r in df.collect()]))
    assert sorted((r.instruction or "", r.output) for r in e.collect()) == want


def test_decoded_pairs_dealt(spark):
    df = addresses(spark)
    e = encode.encode_pairs(corpus.qa_pairs_rule(df.where("cleaned_address IS NOT NULL")), 8, keep=("output",))
    d = encode.decode_ids(e)
    assert dealt_first(d)
    got = d.select("output", "decoded").collect()
    assert len(got) == len(rule_pairs([tuple(r) for r in df.collect() if r.cleaned_address is not None]))
    assert all(len(r.decoded.split()) == 8 for r in got)

def test_regex_pairs_dealt(spark):
    """Equal pairs of addresses with other components are one row."""
    rnd = random.Random(8)
    parts = ["省", "市", "区", "县", "街", "路", "a", " ", "无法确定", "北京"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 5))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "cleaned_address string")
    pairs = corpus.qa_pairs_regex(df)
    assert dealt_first(pairs)
    want, made = set(), 0
    for r in corpus.address_components(df).where(F.col("cleaned_address").isNotNull()).collect():
        p, c = r.c_province, r.c_city
        whole = p + c + r.c_district + r.c_street + r.c_detail
        for q, answer in ((fixed.Q_PROVINCE, fixed.A_PREFIX + p if p else fixed.A_NO_PROVINCE),
                          (fixed.Q_CITY, fixed.A_PREFIX + c if c else fixed.A_NO_CITY),
                          (fixed.Q_STANDARD, (fixed.A_STANDARD + whole).strip())):
            if fixed.NOT_SURE not in answer:
                made += 1
                want.add((q + whole.strip(), "", answer, whole.strip()))
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(want) < made and set(got) == want


def basket(lines):
    """Baskets by hand; a NULL order is an order, a NULL product is in it."""
    qty, orders = {}, {}
    for o, p, q in lines:
        qty[p] = qty.get(p, 0) + q
        orders.setdefault(o, set()).add(p)
    top = min(qty, key=lambda p: (-qty[p], p))
    with_top = [o for o, ps in orders.items() if top in ps]
    out = {}
    for p in qty:
        n, co = sum(p in ps for ps in orders.values()), sum(p in orders[o] for o in with_top)
        if p not in (top, None) and co:
            conf = co / len(with_top)
            out[p] = (co, round(co / len(orders), 6), round(conf, 6), round(conf / (n / len(orders)), 6))
    return out


def test_basket_shares_by_lines(spark, monkeypatch):
    """Shares follow the number of lines; equal lines, lines of one order and
    product, NULL orders and NULL products give the rows counted by hand."""
    rnd = random.Random(4)
    lines = [(rnd.randint(1, 150) if rnd.random() < 0.97 else None, rnd.randint(1, 25), float(rnd.randint(1, 9)))
             for _ in range(400)]
    lines += rnd.sample(lines, 90) + [(o, None, 0.0) for o in (1, 2, 2, None)] + [(7, 3, 900.0)]
    df = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double")
    monkeypatch.setattr(analytics, "TASK_ROWS", 20, raising=False)
    got = analytics.basket_affinity(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-len(lines) // 20)}), REPARTITION_BY_NUM" in plan
    rows = [tuple(r) for r in got.collect()]
    assert {r[0]: r[1:] for r in rows} == basket(lines) and len({r[0] for r in rows}) == len(rows)


def test_basket_of_no_lines(spark):
    df = spark.createDataFrame([], "l_orderkey long, l_partkey long, l_quantity double")
    assert analytics.basket_affinity(df).collect() == []
