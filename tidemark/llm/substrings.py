"""Removal of repeated passages: each word that lies in a window of ``least``
consecutive words whose word sequence starts anywhere else too.

*Levels.*  Only what repeats at a length is looked at again at twice that
length: lengths double from about a quarter of the window (9, 18, 35 for 35)
until no candidates survive or the window itself is compared; what repeats
over more words is covered by its repeated windows.

*Electing.*  At a level below the window each window that is still a
candidate elects one of the shorter windows inside it, the one with the
smallest hash (the first of equal ones).  Windows of equal words elect at the
same place, so a window whose elected one occurs once in the corpus cannot
repeat and goes.  Neighbours mostly elect the same place, so the first level
ships about two of 28 places.  At the last level each candidate ships a
128-bit hash of its words (the only way a different sequence could count as
equal); those that occur once go.

*Where it runs.*  Words are hashed and elected in tasks on slices of bounded
size; counts are ``groupBy`` on hashes, combined before they are shuffled.
Places are kept by a 128-bit hash of their text, so copies of a text share
them and need no row numbers; a text is read again only if it still has
candidates, and the others stay where they are read (if there are more than
``BROADCAST_KEYS`` such texts, the texts are shuffled instead).

Defined cases: a null text has no words; a text with fewer words than the
window keeps them all; rows that repeat are places of their own, so both lose
their windows; the other columns are returned as they are, in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BROADCAST_KEYS, materialise, small, whole_text
from tidemark.llm.words import Words, slices, table

LEAST = 35                      # words of a window
TO = table(b" \t\n\x0b\x0c\r")
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_AT = _U((1 << 28) - 1)         # room for a place in a slice, below the hash


def lengths(least: int) -> list[int]:
    """The lengths of the levels, ``least`` last."""
    out = [least]
    while out[0] > 2 and len(out) < 3:
        out.insert(0, -(-out[0] // 2))
    return out


# --- windows of a slice -------------------------------------------------------------

def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def window_hashes(words: Words, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each place on (polynomial, mixed)."""
    if len(words.ids) < length:
        return np.empty(0, _U)
    of = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words.vocabulary.to_pylist()), _U, len(words.vocabulary))
    with np.errstate(over="ignore"):
        n = len(words.ids)
        sums = np.zeros(n + 1, _U)
        np.cumsum(of[words.ids] * _powers(_BASE, n), out=sums[1:])
        out = (sums[length:] - sums[:-length]) * _powers(_BACK, n)[: n - length + 1]
        out = (out ^ (out >> _U(31))) * _U(0xBF58476D1CE4E5B9)
        return out ^ (out >> _U(29))


def _least_of(x: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each ``n`` neighbours."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def elected(hashes: np.ndarray, length: int, least: int) -> np.ndarray:
    """For each window of ``least`` words the place it elects."""
    if len(hashes) < least - length + 1:
        return np.empty(0, np.int64)
    key = (hashes & ~_AT) | np.arange(len(hashes), dtype=_U)
    return (_least_of(key, least - length + 1) & _AT).astype(np.int64)


@dataclass
class Slice:
    words: Words
    first: np.ndarray     # number of each text's first word, -1 if not seen
    begins: np.ndarray    # windows that are candidates, by their first word

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, place in it) of words of this slice."""
        text = self.words.piece[at]
        return text, self.words.number + at - self.first[text]


def candidates(texts: Sequence[bytes], places: list | None, length: int | None, least: int) -> Iterator[Slice]:
    """Windows that may repeat: all of them, or those that elect one of
    ``places`` (of each text) at ``length``."""
    first = np.full(len(texts), -1, np.int64)
    for words in slices(texts, TO, carry=least - 1):
        seen, index = np.unique(words.piece, return_index=True)
        fresh = first[seen] < 0
        first[seen[fresh]] = words.number + index[fresh]
        n = len(words.ids) - least + 1
        begins = np.arange(max(0, words.fresh - least + 1), max(0, n))
        begins = begins[words.piece[begins] == words.piece[begins + least - 1]]
        if places is not None and len(begins):
            fine = np.zeros(len(words.ids), bool)
            for text in seen:
                at = first[text] - words.number + places[text]
                fine[at[(at >= 0) & (at < len(fine))]] = True
            begins = begins[fine[elected(window_hashes(words, length), length, least)[begins]]]
        yield Slice(words, first, begins)


def _places(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    return [flat[a - ends[0]:b - ends[0]] for a, b in zip(ends[:-1], ends[1:])]


# --- levels -----------------------------------------------------------------------

def _elect(before: int | None, length: int, least: int):
    """(key, at, h): the places elected at ``length`` by the candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            places = _places(batch.column("places")) if before else None
            sent = np.empty(0, np.int64)
            for s in candidates(texts, places, before, least):
                hashes = window_hashes(s.words, length)
                at = np.unique(elected(hashes, length, least)[s.begins])
                # neighbours across a cut may elect the same place
                at = at[~np.isin(at + s.words.number, sent)]
                sent = np.concatenate([sent, at + s.words.number])[-2 * least:]
                text, place = s.place(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(text)), pa.array(place, pa.int32()),
                     pa.array(hashes[at].view(np.int64))], names=["key", "at", "h"])
    return run


def _hash_windows(before: int, least: int):
    """(a, b, ref, at): the 128-bit hash of each candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in candidates(batch.column("text").to_pylist(), _places(batch.column("places")), before, least):
                text, place = s.place(s.begins)
                a, b = (window_hashes(s.words, least, seed)[s.begins].view(np.int64) for seed in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), batch.column("ref").take(pa.array(text)), pa.array(place, pa.int32())],
                    names=["a", "b", "ref", "at"])
    return run


def _cut(before: int, least: int):
    """The texts without the windows of ``places`` that are not in ``lone``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            held = np.flatnonzero(batch.column("places").is_valid().to_numpy(zero_copy_only=False))
            some = batch.take(pa.array(held))
            gone = {}   # text -> words in a repeated window
            lone = _places(some.column("lone")) if len(held) else []
            for s in candidates(some.column("text").to_pylist(), _places(some.column("places")) if len(held) else [],
                                before, least):
                text, place = s.place(s.begins)
                for t in np.unique(text):
                    gone.setdefault(t, []).append(np.setdiff1d(place[text == t], lone[t], assume_unique=True))
            n_words, n_removed, kept = [], [], []
            of = dict(zip(held.tolist(), range(len(held))))
            for i, data in enumerate(texts):
                words, removed = data.split(), 0
                if (t := of.get(i)) in gone:
                    edge = np.zeros(len(words) + 1, np.int64)
                    begins = np.concatenate(gone[t])
                    np.add.at(edge, begins, 1)
                    np.add.at(edge, begins + least, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    removed = int(len(words) - stays.sum())
                    words = [words[k] for k in np.flatnonzero(stays)]
                n_words.append(len(words) + removed)
                n_removed.append(removed)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary())], names=["row", "n_words", "n_removed", "kept"])
    return run


def _holding(docs: DataFrame, found: DataFrame, all_rows: bool = False) -> DataFrame:
    """``docs`` joined to what was found for their texts; the other rows are
    left out, or not moved at all."""
    keys = found.select("key")
    if keys.limit(BROADCAST_KEYS + 1).count() > BROADCAST_KEYS:
        return docs.join(found, "key", "left" if all_rows else "inner")
    keys = F.broadcast(keys)
    here = docs.join(keys, "key", "left_semi").join(found, "key")
    if not all_rows:
        return here
    return here.unionByName(docs.join(keys, "key", "left_anti"), allowMissingColumns=True)


def drop_repeats(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: ``row`` (its other columns), ``n_words``,
    ``n_removed`` and ``kept`` (the words that stay, joined by one space).
    ``least`` is 3 at least, so that there is a shorter level."""
    if least < 3:
        raise ValueError("a window has at least 3 words")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row"), whole_text(f"`{text_col}`").alias("t"))
    rows = rows.select("row", F.unhex(F.md5("t")).alias("key"), F.col("t").cast("binary").alias("text"))
    texts = rows.select("key", "text")
    steps, before, found = lengths(least), None, None
    for length in steps[:-1]:
        if found is not None:
            if found.isEmpty():
                break
            texts = _holding(rows.select("key", "text"), found.select("key", "places"))
        marks = materialise(texts.mapInArrow(_elect(before, length, least), "key binary, at int, h long"), "repeat-marks")
        # copies of a text mark equal places, which are places of their own
        again = materialise(marks.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeat-hashes")
        live = (marks.join(small(again, BROADCAST_KEYS), "h", "left_semi").groupBy("key")
                     .agg(F.sort_array(F.collect_set("at")).alias("places")))
        found = materialise(live.withColumn("ref", F.monotonically_increasing_id()), "repeat-places")
        before = length
    texts = _holding(rows.select("key", "text"), found)
    lone = (texts.mapInArrow(_hash_windows(before, least), "a long, b long, ref long, at int")
                 .groupBy("a", "b").agg(F.count("*").alias("n"), F.min("ref").alias("ref"), F.min("at").alias("at"))
                 .where("n = 1").groupBy("ref").agg(F.collect_list("at").alias("lone")))
    done = materialise(found.join(lone, "ref", "left").select(
        "key", "places", F.coalesce("lone", F.array().cast("array<int>")).alias("lone")), "repeat-windows")
    schema = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType())])
    out = _holding(rows, done, all_rows=True).select("row", "text", "places", "lone")
    return out.mapInArrow(_cut(before, least), schema).withColumn("kept", F.col("kept").cast("string"))
