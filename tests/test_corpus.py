"""Address corpus: the two generators against stored and hand-computed
outputs."""

from pyspark.sql import functions as F

from tidemark.operators import corpus


def rows(df, cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_rule_corpus_golden(spark):
    dim = corpus.address_dimension(spark)
    pairs = corpus.qa_pairs_rule(corpus.clean_addresses(dim))
    assert pairs.count() == 40
    got = rows(pairs, ["instruction", "output", "original_address"])
    # stored output rows (retyped)
    assert ("这个地址在哪个市？湖北省武汉市武昌区东湖路", "这个地址在武汉市", "湖北省武汉市武昌区东湖路") in got
    assert ("这个地址在哪个区/县？陕西省西安市雁塔区高新路", "这个地址在雁塔区", "陕西省西安市雁塔区高新路") in got
    assert ("这个地址在哪个省？山东省济南市历下区泉城广场", "这个地址在山东省", "山东省济南市历下区泉城广场") in got
    beijing = {o for _, o, a in got if a.startswith("北京")}
    assert beijing == {"标准化地址：北京北京市海淀区中关村大街", "这个地址在北京市", "这个地址在北京省", "这个地址在海淀区"}


def test_regex_corpus_golden(spark):
    dim = corpus.address_dimension(spark)
    pairs = corpus.qa_pairs_regex(corpus.clean_addresses(dim))
    got = rows(pairs, ["instruction", "input", "output", "original_address"])
    assert len(got) == 28 and pairs.count() == 28
    assert all(i == "" for _, i, _, _ in got)
    assert len({a for _, _, _, a in got}) == 10  # every address is standardised
    assert sum(q.startswith("请标准化这个地址：") for q, _, _, _ in got) == 10
    assert all("无法确定" not in o for _, _, o, _ in got)
    doubled = "北京市北京市海淀区北京市海淀区中关村大街海淀区中关村大街1号"
    assert ("这个地址在哪个市？" + doubled, "", "这个地址在北京市", doubled) in got
    assert ("请标准化这个地址：" + doubled, "", "标准化地址：" + doubled, doubled) in got


def test_regex_corpus_messy_input(spark):
    """Expected rows worked out by hand from the component rules."""
    addrs = ["ab", None, "", "甘肃省兰州市城关区"]
    df = spark.createDataFrame([(a,) for a in addrs], "address string")
    got = rows(corpus.qa_pairs_regex(corpus.clean_addresses(df)), ["instruction", "input", "output"])
    outputs = {o for _, _, o in got}
    assert "这个地址在甘肃省" in outputs
    assert len(got) == 3 and all(i == "" for _, i, _ in got)
    assert {q.split("？")[0] for q, _, _ in got if "？" in q} == {"这个地址在哪个省", "这个地址在哪个市"}


def test_clean_by_hand(spark):
    given = {"a b　c": "a b c", "Ünïcödé—dash…": "Ünïcödédash", "tab\tand\x1cfs": "tab and fs", "  lead": "lead",
             "emoji 😀 ok": "emoji ok", "keep-these.chars_1": "keep-these.chars_1", "\u200bzero": "zero",
             "Ⅻ numerals ½ ²": "Ⅻ numerals ½ ²", "a\x0bb\x85c": "a b c", "!!": "", "北京市，海淀区": "北京市海淀区"}
    df = spark.createDataFrame([(t,) for t in given], "t string")
    from tidemark.functions.text import clean_text
    assert {r.t: r.c for r in df.select("t", clean_text("t").alias("c")).collect()} == given


def test_features(spark):
    df = spark.createDataFrame([("内蒙古自治区呼和浩特市新城区胡同",), ("abc",)], "cleaned_address string")
    r = corpus.address_features(df).orderBy("cleaned_address").collect()
    assert (r[1].has_province, r[1].has_city, r[1].has_district, r[1].has_street) == (1, 1, 1, 1)
    assert (r[0].has_province, r[0].address_length, r[0].word_count) == (0, 3, 3)


def test_chat_and_response(spark):
    conv = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "  hello\n"),
         (1, 3, "user", "bye"), (2, 0, "user", "q"), (2, 1, "user", "q2")],
        "conv_id long, turn long, role string, text string")
    t = corpus.chat_turns(conv, "train").collect()
    assert [(r.turn, r.chat) for r in t] == [
        (1, "<|im_start|>user hi <|im_end|> <|im_start|>assistant   hello\n <|im_end|>")]
    p = corpus.chat_turns(conv, "prompt").select(
        "conv_id", "turn", F.concat("chat", "output", F.lit("<|im_end|>")).alias("g"))
    assert corpus.responses(p, "g").collect()[0].response == "hello"
