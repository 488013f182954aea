"""Token counts and byte-level BPE against the libraries themselves."""

import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")


def odd_texts():
    rng = random.Random(5)
    parts = list("abcXYZ 123  \n\n\t\r'sn't!?.,;:") + [
        " ", " ", "​", "՘", "࢏", "\U00011de0", "é", "ñ", "ü", "漢字", "ـ", "٣", "Ⅷ", "²",
        "\x1c", "\x85", "﻿", "😀", "👩‍👧", "<|endoftext|>", " word", "\nLine"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    return made + ["", " ", "\n", "a ", " a", "a\n\nb", "a \nb", "x" * 20000, " " * 3000, "don't we'll 's",
                   "<|endoftext|>", "a<|endoftext|> b", "word " * 3000]


@pytest.fixture(scope="module")
def rows():
    texts = odd_texts()
    return [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "no id"), (90001, None)]


def frame(spark, rows):
    # columns whose names the operators use themselves
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                 "doc_id long, text string, id string, n_tokens int").repartition(3)


def test_counts_as_the_library(spark, rows):
    lib = Tokenizer.from_file(JSON)
    want = sorted((i is None, i or 0, len((t or "").encode()),
                   len(lib.encode(t or "", add_special_tokens=False))) for i, t in rows)
    got = token_counts.token_counts(frame(spark, rows), JSON, P.PATTERN).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_proven_strings_are_single_tokens():
    lib = Tokenizer.from_file(JSON)
    with open(JSON, encoding="utf-8") as f:
        proven = token_counts.prove_whole(f.read())
    assert len(proven) > 40000
    for s in random.Random(1).sample(sorted(proven), 2000):
        if s != "<|endoftext|>":
            one = lib.model.tokenize("".join(token_counts.byte_characters()[b] for b in s.encode()))
            assert len(one) == 1


def test_round_trip_as_the_library(spark, rows):
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = []
    for i, t in rows:
        ids = lib.encode_ordinary(t or "")
        want.append((i is None, i or 0, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.round_trip(frame(spark, rows), RANKS, P.PATTERN).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_decode_inverts_encode(spark, rows):
    some = frame(spark, rows[:60] + [(90001, None)])
    back = bpe.decode(bpe.encode(some, RANKS, P.PATTERN), RANKS)
    assert {r.doc_id: bytes(r.bytes).decode() for r in back.collect()} == {i: t or "" for i, t in rows[:60] + [(90001, None)]}


def test_ranks_must_be_dense():
    with pytest.raises(ValueError):
        bpe.serialise({b"a": 0, b"b": 2})


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(none, JSON, P.PATTERN).count() == 0
    assert bpe.round_trip(none, RANKS, P.PATTERN).count() == 0
