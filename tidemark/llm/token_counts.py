"""Token counts of a byte-level BPE tokenizer with a whole-token shortcut.

Before any text is read, every string of the vocabulary is put through the
tokenizer's own merges; those that come out as that one token are proven
whole.  A pre-token of a text that is proven whole counts one without being
merged; only the rest are merged.

The vocabulary and the proven strings (bounded by the vocabulary's size)
are broadcast; texts stay where they are read.

Defined cases: a null text has no bytes and no tokens; special strings in a
text are single tokens, as the library takes them by default; rows with
equal ids are counted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import whole_text
from tidemark.llm.pretokens import Words


@lru_cache(maxsize=1)
def byte_characters() -> tuple[str, ...]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the others follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return tuple(chr(b) if b in plain else chr(next(others)) for b in range(256))


def prove_whole(tokenizer_json: str) -> frozenset[str]:
    """The vocabulary's strings, as text, that encode alone as one token."""
    model = Tokenizer.from_str(tokenizer_json).model
    tok = Tokenizer.from_str(tokenizer_json)
    byte_of = {ch: b for b, ch in enumerate(byte_characters())}
    proven = set()
    for piece, number in tok.get_vocab(with_added_tokens=False).items():
        got = model.tokenize(piece)
        if len(got) == 1 and got[0].id == number:
            try:
                proven.add(bytes(byte_of[ch] for ch in piece).decode("utf-8"))
            except (KeyError, UnicodeDecodeError):
                continue  # no whole text: it can't be a pre-token
    return frozenset(proven)


class Counter:
    """Counts tokens of texts; ``proven`` as given by :func:`prove_whole`."""

    def __init__(self, tokenizer_json: str, proven: frozenset[str], pattern: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.proven = proven
        self.chars = dict(enumerate(byte_characters()))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Words(pattern, self._counts)

    def merged(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.chars)))

    def _counts(self, lists: list[list[str]]) -> list[int]:
        proven, merged = self.proven, self.merged
        return [sum([1 if p in proven else merged(p) for p in pieces]) for pieces in lists]

    def count(self, text: str) -> int:
        parts = [text]
        n = 0
        for s in self.special:
            parts = [x for p in parts for x in p.split(s)]
        if len(parts) > 1:
            n = len(parts) - 1
        return n + sum([sum(self.words.values(p)) for p in parts])


@lru_cache(maxsize=2)
def _counter(tokenizer_json: str, proven: frozenset[str], pattern: str) -> Counter:
    return Counter(tokenizer_json, proven, pattern)


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens
    than ``limit``).  ``vocabulary`` is the path of a tokenizer file that the
    driver reads."""
    with open(vocabulary, encoding="utf-8") as f:
        tokenizer_json = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, prove_whole(tokenizer_json)))
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*shared.value, pattern)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text"))
    out = rows.mapInArrow(run, f"id {kind.simpleString()}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
