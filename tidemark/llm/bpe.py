"""Byte-level BPE encoding and decoding with a sentencepiece model that is
serialised from the vocabulary.

A rank file lists byte strings by merge rank.  Each byte is mapped to one
character of its own, every byte string becomes a piece with score minus
its rank, and the normalisation is the identity; sentencepiece's BPE then
merges what the rank file's library would merge.  Pre-tokens that are in
the vocabulary get their id at once, as that library does.  Ids decode by
the inverse of both mappings, read back from the model.

The serialised model (bounded by the vocabulary) is broadcast.

Defined cases: a null text counts as empty, without ids; special strings
are ordinary text; rows with equal ids are encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tidemark.llm.common import whole_text
from tidemark.llm.pretokens import Words

FIRST_CHAR = 0x100  # the character of byte 0; no white space, nothing to normalise
GAP = " "           # maps no byte
CHUNK = 1000         # pre-tokens that sentencepiece gets at once
MAPPED = "".join(chr(FIRST_CHAR + b) for b in range(256))


def to_piece(data: bytes) -> str:
    return data.decode("latin-1").translate(_FORWARD)


def to_bytes(piece: str) -> bytes:
    return bytes(ord(ch) - FIRST_CHAR for ch in piece)


_FORWARD = dict(enumerate(MAPPED))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    model = proto.ModelProto()
    for data, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece=to_piece(data), score=-float(rank),
                         type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type = proto.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(ranks), -1, -1, -1
    rule = model.normalizer_spec
    rule.name = "identity"
    rule.add_dummy_prefix = rule.remove_extra_whitespaces = rule.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes texts to ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, model: bytes, pattern: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.table = [to_bytes(self.sp.id_to_piece(i)) for i in range(self.sp.unk_id())]
        self.known = {data: i.to_bytes(4, "little") for i, data in enumerate(self.table)}
        self.words = Words(pattern, self._encode)

    def _merge(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each pre-token.  Many go to sentencepiece in one string,
        held apart by a character that no piece has: it is unknown, so
        nothing merges over it, and its id marks the ends."""
        merged = {}
        for start in range(0, len(pieces), CHUNK):
            some = pieces[start:start + CHUNK]
            ids = np.array(self.sp.encode(GAP.join(map(to_piece, some)), out_type=int), "<u4")
            ends = [*np.flatnonzero(ids == self.sp.unk_id()).tolist(), len(ids)]
            data, at = ids.tobytes(), 0
            for piece, end in zip(some, ends, strict=True):
                merged[piece] = data[4 * at:4 * end]
                at = end + 1
        return merged

    def _encode(self, lists: list[list[str]]) -> list[bytes]:
        known = self.known
        pieces = [[p.encode("utf-8") for p in one] for one in lists]
        merged = self._merge(list({p for one in pieces for p in one if p not in known}))
        return [b"".join([known[p] if p in known else merged[p] for p in one]) for one in pieces]

    def encode(self, text: str) -> bytes:
        return b"".join(self.words.values(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: id and ``ids`` (array of long)."""
    return _coded(docs, ranks, pattern, id_col, text_col, whole=True).select(
        F.col("id").alias(id_col), "ids")


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (of
    the bytes that the ids decode to)."""
    return _coded(docs, ranks, pattern, id_col, text_col, whole=False).select(
        F.col("id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256")


def _coded(docs: DataFrame, ranks: str, pattern: str, id_col: str, text_col: str, whole: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks)))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            if whole:
                ids = [np.frombuffer(codec.encode(t), "<u4").astype("int64") for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(ids, pa.list_(pa.int64()))], names=["id", "ids"])
                continue
            n, a, b = [], [], []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text)
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    schema = (f"id {kind}, ids array<long>" if whole else
              f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return rows.mapInArrow(run, schema)


def decode(coded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``bytes``, the inverse of :func:`encode`."""
    shared = coded.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks)))
    kind = coded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, "")
        for batch in batches:
            data = [None if ids is None else b"".join(map(codec.table.__getitem__, ids))
                    for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], names=["id", "bytes"])

    rows = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, bytes binary").select(F.col("id").alias(id_col), "bytes")
