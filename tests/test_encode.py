"""Vocabulary encoding: hand-computed ids, properties and limits."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import tokens as K
from tidemark.operators import encode


def test_encode_by_hand(spark):
    """Ids read off the vocabulary by hand: 19 北京, 51 路, 52 号, 53 无法,
    54 确定, 55 。; 1 stands for what it does not have."""
    given = {"北京 路号": [19, 51, 52], "abc": [1, 1, 1], "": [], "无法 确定。": [53, 1, 1, 55],
             " 路\t号\n路 ": [51, 52, 51], "号" * 300: [52] * 300}
    df = spark.createDataFrame([(t,) for t in given], "t string")
    got = {r.t: list(r.ids) for r in df.select("t", K.token_ids("t").alias("ids")).collect()}
    assert got == given
    cut = {r.t: list(r.ids) for r in df.select("t", K.encode("t", 128).alias("ids")).collect()}
    assert cut["北京 路号"] == [19, 51, 52] + [0] * 125 and cut["号" * 300] == [52] * 128


def test_all_ids_of_a_long_text_are_kept(spark):
    pairs = spark.createDataFrame([("路 " * 500, "号 " * 400)], "instruction string, output string")
    r = encode.encode_pairs(pairs, 128).collect()[0]
    assert len(r.input_ids) == 128 and r.n_tokens > 900


def test_vocabulary_of_a_thousand(spark):
    vocab = {f"word{i}": i for i in range(2, 1000)} | {"[PAD]": 0, "[UNK]": 1, "!": 1000, "7": 1001, "-": 1002, "]": 1003}
    df = spark.createDataFrame([("word2 word999 !7-]x word500",)], "t string")
    r = df.select(K.token_ids("t", vocab).alias("ids")).select("ids", K.decode("ids", vocab).alias("d")).first()
    assert list(r.ids) == [2, 999, 1000, 1001, 1002, 1003, 1, 500]
    assert r.d == "word2 word999 ! 7 - ] [UNK] word500"
    with pytest.raises(ValueError):
        K.token_ids("t", {"a": 1 << 21})


def test_encode_pairs_shapes(spark):
    pairs = spark.createDataFrame([("这个地址在哪个省？", "这个地址在北京省")], "instruction string, output string")
    r = encode.encode_pairs(pairs, fixed.MAX_LENGTH).collect()[0]
    assert len(r.input_ids) == 128 and r.labels == r.input_ids and r.attention_mask == [1] * 128
    assert r.input_ids[:2] == [5, 7]


def test_split(spark):
    small = spark.range(3).withColumnRenamed("id", "k")
    s = encode.train_eval_split(small, "k", duplicate_all=True).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in s} == {"train": 3, "eval": 3}
    assert encode.train_eval_split(small, "k").count() == 3  # no change of behaviour by size
    big = spark.range(2000).withColumnRenamed("id", "k")
    b = encode.train_eval_split(big, "k")
    n_eval = b.where(F.col("split") == "eval").count()
    assert b.count() == 2000 and 300 < n_eval < 500
    again = encode.train_eval_split(big.repartition(7), "k").where(F.col("split") == "eval").count()
    assert again == n_eval


def test_token_ids_and_pad(spark):
    df = spark.createDataFrame([("北京 abc 路号",), ("",)], "t string")
    r = df.select(K.token_ids("t").alias("ids"), K.pad_truncate(K.token_ids("t"), 4).alias("p")).collect()
    assert r[0].ids == [19, 1, 1, 1, 51, 52] and r[0].p == [19, 1, 1, 1]
    assert r[1].ids == [] and r[1].p == [0, 0, 0, 0]
