"""Phrase collocations of each language by best-first branch and bound.

A phrase of 2 to ``longest`` words with count ``a`` is scored at every cut
into a first part (count ``l``) and the rest (``r``) by
``floor(SCALE * a / (l + r))``; the lowest-scoring cut counts.  Phrases grow
word by word from their prefixes.  A prefix ``q`` with first word ``w``
bounds everything that grows from it: such a phrase has ``a <= f(q)``, and
its cut after ``w`` has ``l = f(w)`` and ``r >= a``, so no score passes
``SCALE * f(q) / (f(w) + f(q))``.  Before a pair of words is counted the
smaller of its words' counts takes the place of ``f(q)``.

*Best first.*  The frontier is expanded from the highest bounds down, in
bands (``BANDS``): one reading of the texts counts the children of all
prefixes of a length whose bounds are in the band.  A language is settled
once it has ``top`` surviving phrases with scores from the band's lower edge
on: whatever was not expanded is bounded below that edge, so ties are
settled too.  The last band reaches 0 and leaves nothing out.

*Rests and survival.*  Counts of rests that did not grow from a prefix
themselves are taken in a reading of their own, for phrases whose known cuts
reach the band.  A phrase goes when a longer one around it is nearly as
frequent; then one by a single word is (its count is no smaller), so the
children of a phrase and the phrases one word to its left decide.

*What is shipped.*  Tasks learn word counts and sets of prefixes from tables
of a fixed number of hash buckets (smallest and largest count in a bucket;
one flag a bucket), whose size does not grow with the data.  Buckets that
several phrases share loosen a bound and let more be counted; counts of
everything that is counted are exact, as all occurrences of a phrase pass or
fail alike.  Phrases are counted a slice of text at a time, so that a phrase
travels once a slice, not once an occurrence.

Defined cases: a null text is empty, a null language is ``und`` (and one
with texts of that name); words are runs of bytes without blanks, only A-Z
become small; repeated rows count each; further columns are ignored; no
rows, no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, small, whole_text
from tidemark.llm.words import Words, slices, table

LEAST = 30              # occurrences of a candidate
LONGEST = 4             # words
TOP = 2000              # phrases a language
SCALE = 2_000_000
CONTAINED = 100, 80     # goes if 100 * f(longer) >= 80 * a
BANDS = 100_000, 1_000, 0   # lower edges of the bounds that are expanded in turn
COUNT_BITS = 20         # buckets of word counts
FLAG_BITS = 22          # buckets of a set of phrases
SLICE = 4 << 20         # bytes of text whose phrases are counted together
TO = table(b" \t", b".,;:!?\n\x0b\x0c\r", lower=True)
_U = np.uint64
_ROWS = "lang string, phrase string, a long"


# --- phrases in tasks ----------------------------------------------------------

def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), _U, len(words))


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of each phrase from the hashes of its words, in order."""
    with np.errstate(over="ignore"):
        out = parts[0]
        for p in parts[1:]:
            out = (out ^ (out >> _U(29))) * _U(0xBF58476D1CE4E5B9) + p
        return (out ^ (out >> _U(32))) * _U(0x94D049BB133111EB)


def bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; ``buckets`` is a power of 2."""
    return (hashes >> _U(65 - buckets.bit_length())).astype(np.int64)


@dataclass
class Counts:
    """Smallest and largest count of the words of each bucket; 0 without."""
    low: np.ndarray
    high: np.ndarray


@dataclass
class Pairs:
    """Pairs of words whose bound is from ``edge`` on and below ``above``."""
    edge: int
    above: int | None

    def lengths(self) -> list[int]:
        return [2]

    def admits(self, n: int, at: np.ndarray, hashed: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least, most = low[at - 1].astype(np.float64), high[at].astype(np.float64)
        a = np.minimum(least, most)  # with f(w) = least, the worst case
        bound = np.floor(SCALE * a / (least + a)) + 1
        return (bound >= self.edge) & ((self.above is None) | (bound < (self.above or 0)))


@dataclass
class Parts:
    """Phrases of which a part is in a set: (phrase length, first word of
    the part, words of the part, flags of the set)."""
    tests: list[tuple[int, int, int, np.ndarray]]

    def lengths(self) -> list[int]:
        return sorted({n for n, *_ in self.tests})

    def admits(self, n: int, at: np.ndarray, hashed: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), bool)
        for length, first, words, flags in self.tests:
            if length == n:
                begin = at - n + 1 + first
                out |= flags[bucket(fold([hashed[begin + k] for k in range(words)]), len(flags))]
        return out


def occurrences(ids: np.ndarray, at: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence (its last word) of each phrase that ends ``at`` and
    how many there are."""
    key = ids[at - n + 1].astype(np.int64)
    for k in range(n - 2, -1, -1):
        if k < n - 2:
            key = np.unique(key, return_inverse=True)[1]
        key = key * size + ids[at - k]
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return at[first], count


def phrases_at(words: Words, at: np.ndarray, n: int) -> pa.Array:
    parts = [words.vocabulary.take(pa.array(words.ids[at - k])) for k in range(n - 1, -1, -1)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())).cast(pa.string(), safe=False)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    code = batch.column("lang").dictionary_encode()
    of = code.indices.to_numpy()
    for k, lang in enumerate(code.dictionary.to_pylist()):
        yield lang, batch.column("text").take(pa.array(np.flatnonzero(of == k))).to_pylist()


def _rows(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(phrases), np.int32))), phrases,
                                       pa.array(counts, pa.int64())], names=["lang", "phrase", "a"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and, as null, how many there are."""
    for batch in batches:
        for lang, texts in _by_language(batch):
            for words in slices(texts, TO, 0, SLICE):
                counts = np.bincount(words.ids, minlength=len(words.vocabulary))
                yield _rows(lang, words.vocabulary.cast(pa.string(), safe=False), counts)
                yield _rows(lang, pa.nulls(1, pa.string()), np.array([len(words.ids)]))


def _count_phrases(counts, admit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, only = counts.value, admit.value
        lengths = only.lengths()
        for batch in batches:
            for lang, texts in _by_language(batch):
                for words in slices(texts, TO, max(lengths) - 1, SLICE):
                    hashes = word_hashes(words.vocabulary.to_pylist(), lang)
                    low, high = (side[bucket(fold([hashes]), len(side))] for side in (known.low, known.high))
                    often = (high > 0)[words.ids]
                    low, high, hashed = low[words.ids], high[words.ids], hashes[words.ids]
                    for n in lengths:
                        at = np.arange(max(words.fresh, n - 1), len(words.ids))
                        fine = words.piece[at] == words.piece[at - n + 1]
                        for k in range(n):
                            fine &= often[at - k]
                        at = at[fine]
                        at = at[only.admits(n, at, hashed, low, high)]
                        if len(at):
                            at, count = occurrences(words.ids, at, n, len(words.vocabulary))
                            yield _rows(lang, phrases_at(words, at, n), count)
    return run


# --- tables of a fixed size -------------------------------------------------------

def _buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, a) of each phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(len(batch), np.int32)
            code = batch.column("lang").dictionary_encode()
            of = code.indices.to_numpy()
            phrases = [p.split(b" ") for p in batch.column("phrase").to_pylist()]
            for k, lang in enumerate(code.dictionary.to_pylist()):
                mine = np.flatnonzero(of == k)
                for n in {len(phrases[i]) for i in mine}:
                    some = np.array([i for i in mine if len(phrases[i]) == n])
                    parts = [word_hashes([phrases[i][j] for i in some], lang) for j in range(n)]
                    out[some] = bucket(fold(parts), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(out), batch.column("a")], names=["bucket", "a"])

    return rows.select("lang", F.col("phrase").cast("binary").alias("phrase"), "a").mapInArrow(run, "bucket int, a long")


def _counts(words: DataFrame) -> Counts:
    got = (_buckets(words, 1 << COUNT_BITS).groupBy("bucket").agg(F.min("a").alias("low"), F.max("a").alias("high"))
           .toArrow())
    out = Counts(np.zeros(1 << COUNT_BITS, np.int64), np.zeros(1 << COUNT_BITS, np.int64))
    at = got.column("bucket").to_numpy()
    out.low[at], out.high[at] = got.column("low").to_numpy(), got.column("high").to_numpy()
    return out


def _flags(rows: DataFrame) -> np.ndarray:
    out = np.zeros(1 << FLAG_BITS, bool)
    out[_buckets(rows, 1 << FLAG_BITS).select("bucket").distinct().toArrow().column("bucket").to_numpy()] = True
    return out


# --- scores -----------------------------------------------------------------------

def _whole(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def _score(a: Column, both: Column) -> Column:
    """floor(SCALE * a / both); products may pass 64 bits."""
    return F.call_function("div", _whole(a) * F.lit(SCALE).cast("decimal(7,0)"), both.cast("decimal(21,0)"))


def _part(first, length) -> Column:
    return F.array_join(F.slice("w", first, length), " ")


def _scored(cand: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a, best cut's score, k, l, r) with the count ``a`` in
    place of rests not counted yet, which no rest is below; and those rests."""
    w = F.split("phrase", " ")
    cut = (cand.withColumn("w", w).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
               .select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"),
                       _part(F.col("k") + 1, F.size("w")).alias("rest")))
    side = lambda name, as_: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(as_))
    cut = cut.join(side("first", "l"), ["lang", "first"]).join(side("rest", "known"), ["lang", "rest"], "left")
    cut = materialise(cut.withColumn("r", F.coalesce("known", "a"))
                         .withColumn("score", _score(F.col("a"), _whole(F.col("l")) + _whole(F.col("r")))), "phrase-cuts")
    best = (cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
               .select("lang", "phrase", "a", "best.*"))
    return best, cut.where("known is null").select("lang", "phrase", "rest")


def _bounds(nodes: DataFrame, words: DataFrame) -> DataFrame:
    """``nodes`` with the bound of what grows from them."""
    first = words.select("lang", F.col("phrase").alias("head"), F.col("a").alias("f"))
    return (nodes.withColumn("head", F.element_at(F.split("phrase", " "), 1)).join(first, ["lang", "head"])
                 .withColumn("bound", _score(F.col("a"), _whole(F.col("f")) + _whole(F.col("a")))))


def _contained(longer: DataFrame) -> DataFrame:
    """(lang, phrase, around): the largest count of a phrase that is longer
    by one word, for its first and its last words."""
    w = longer.withColumn("w", F.split("phrase", " "))
    inner = F.explode(F.array(_part(F.lit(1), F.size("w") - 1), _part(F.lit(2), F.size("w") - 1)))
    return w.select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
                 longest: int = LONGEST, top: int = TOP, contained: tuple[int, int] = CONTAINED,
                 bands: tuple[int, ...] = BANDS) -> DataFrame:
    """The best ``top`` phrases of each language: ``lang``, ``rank``,
    ``phrase``, ``a``, ``l``, ``r``, ``n`` (words of the language), ``score``.
    Ties in the score go to greater ``a``, then by the phrase's bytes.
    ``bands`` fall to 0, and ``longest`` is 3 at least."""
    if longest < 3 or bands[-1] != 0:
        raise ValueError("longest is 3 at least, and the last band's edge 0")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), whole_text(text_col).cast("binary").alias("text"))
    broadcast = spark.sparkContext.broadcast

    totals = materialise(texts.mapInArrow(_count_words, _ROWS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
                              .where(F.col("phrase").isNull() | (F.col("a") >= least)), "phrase-words")
    all_words = totals.where("phrase is null").select("lang", F.col("a").alias("n"))
    words = totals.where("phrase is not null")
    word_counts = broadcast(_counts(words))
    held = {n: None for n in range(2, longest + 1)}   # counted phrases by length
    open_langs, settled = small(all_words.select("lang")), []

    def count(admit) -> DataFrame:
        some = texts.join(open_langs, "lang", "left_semi")
        rows = some.mapInArrow(_count_phrases(word_counts, broadcast(admit)), _ROWS)
        return (rows.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least))

    def add(found: DataFrame, n: int) -> None:
        if held[n] is not None:
            found = held[n].unionByName(found).groupBy("lang", "phrase").agg(F.max("a").alias("a"))
        held[n] = materialise(found, f"phrases-{n}")

    def counted(most: int) -> DataFrame:
        return reduce(DataFrame.unionByName, [held[n] for n in range(2, most + 1)], words)

    def ours(rows: DataFrame) -> DataFrame:
        return rows.join(open_langs, "lang", "left_semi")

    above = None
    for edge in bands:
        def in_band(c: str, edge=edge, above=above) -> Column:
            return (F.col(c) >= edge) & (F.lit(True) if above is None else F.col(c) < above)

        add(count(Pairs(edge, above)), 2)
        for n in range(3, longest + 1):
            grown = _bounds(ours(held[n - 1]), words).where(in_band("bound"))
            likely = _scored(ours(held[n - 1]), counted(n - 1))[0].where(in_band("score"))
            add(count(Parts([(n, 0, n - 1, _flags(grown)), (n, 1, n - 1, _flags(likely))])), n)
        candidates = ours(reduce(DataFrame.unionByName, [held[n] for n in range(2, longest + 1)]))
        best, rests = _scored(candidates, counted(longest))
        wanted = (rests.join(best.where(F.col("score") >= edge), ["lang", "phrase"], "left_semi")
                       .select("lang", F.col("rest").alias("phrase"), F.lit(0).cast("long").alias("a")).distinct())
        wanted = materialise(wanted, "phrase-rests")
        if not wanted.isEmpty():
            flags = _flags(wanted)
            found = materialise(count(Parts([(n, 0, n, flags) for n in range(2, longest)]))
                                .join(wanted.drop("a"), ["lang", "phrase"], "left_semi"), "phrase-found")
            for n in range(2, longest):
                add(found.where(F.size(F.split("phrase", " ")) == n), n)
            candidates = ours(reduce(DataFrame.unionByName, [held[n] for n in range(2, longest + 1)]))
            best = _scored(candidates, counted(longest))[0]
        best = best.where(F.col("score") >= edge)
        around = reduce(DataFrame.unionByName, [_contained(ours(held[n])) for n in range(3, longest + 1)])
        around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
        gone = F.coalesce(contained[0] * _whole(F.col("around")) >= contained[1] * _whole(F.col("a")), F.lit(False))
        order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        kept = materialise(best.join(around, ["lang", "phrase"], "left").where(~gone)
                               .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "phrases-kept")
        done = kept.where(F.col("rank") == top).select("lang") if edge > 0 else open_langs
        settled.append(kept.join(done, "lang", "left_semi"))
        above = edge
        if edge > 0:
            open_langs = materialise(open_langs.join(done, "lang", "left_anti"), "phrase-languages")
            if open_langs.isEmpty():
                break
            open_langs = small(open_langs)
    return (reduce(DataFrame.unionByName, settled).join(all_words, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
