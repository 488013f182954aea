"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's rating is a grade 0 < 1 < ... < K-1.  One vector of weights
over hashed text features gives its score; ordered thresholds turn it into
``P(grade > k) = sigmoid(score - threshold[k])``, from which the expected
grade and the tail probability ``P(grade >= good)`` follow.

Features come from a document's distinct words and are additive over them:
a word and its beginnings count by their presence, the ends and shapes of
words by the share of words that have them; how often words repeat is one
more feature.  So at prediction a word's two weights are looked up once and
kept in a bounded memo.  An L1 penalty keeps the weights of features
without evidence at zero, so that long texts don't add up noise.

Fitting takes a bounded sample: at most ``SAMPLE`` rated rows in the order
of a hash of their id.  Their hashed features, not their texts, go to the
driver; the weights (2**BITS numbers) are broadcast.

Defined cases: null texts count as empty and are scored like any other
text; without ratings, or with one grade only, nothing can be learned and
every document is kept; a row rated twice counts with each of its ratings.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import whole_text

SAMPLE = 6000       # rated rows that are fitted on, at most
BITS = 18
EPOCHS, BATCH, RATE, SPARSE = 10, 64, 0.3, 1.5e-3
SHARE = 20.0        # value of a feature that all words have
KEEP = 0.4          # least tail probability of a document that stays
MEMO = 400_000

_RUN = re.compile(r"(.)\1+")
_SYMBOLS = re.compile(r"[^\w\s]+")
_SHAPE = str.maketrans({**{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)},
                        **{chr(c): "0" for c in range(48, 58)}})


def _hash(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8")) & ((1 << BITS) - 1)


def word_features(word: str) -> tuple[list[int], list[int]]:
    """(features that count by presence, features that count by share)"""
    low = word.lower()
    shape = _RUN.sub(r"\1", word.translate(_SHAPE))
    return [_hash("w" + low), _hash("p" + low[:5]), _hash("q" + low[:4])], [_hash("e" + low[-2:]), _hash("s" + shape)]


def text_features(text: str, words: list[str], distinct: int) -> list[int]:
    """How often words repeat, in steps of a factor 1.4, whether a word
    follows itself, and how many of the characters are symbols."""
    twice = sum(map(str.__eq__, words, words[1:]))
    symbols = sum(map(len, _SYMBOLS.findall(text)))
    return [_hash(f"r{round(2 * np.log2(max(1, len(words)) / max(1, distinct)))}"),
            _hash(f"t{round(20 * twice / max(1, len(words)))}"),
            _hash(f"y{round(40 * symbols / max(1, len(text)))}")]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and their values."""
    words = text.split()
    distinct = set(words)
    present = text_features(text, words, len(distinct))
    shared: list[int] = []
    for w in sorted(distinct):
        a, b = word_features(w)
        present += a
        shared += b
    value = np.ones(len(present) + len(shared), np.float32)
    value[len(present):] = SHARE / max(1, len(distinct))
    return np.array(present + shared, np.int32), value


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    grades: int
    weights: np.ndarray
    thresholds: np.ndarray   # ascending, one fewer than grades

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) of each score, scores x (grades - 1)."""
        return _sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def train(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, seed: int = 3) -> Model:
    """Minimise the cumulative-link loss, with an L1 penalty on the weights,
    by AdaGrad over mini-batches.

    ``P(y=k) = s(t[k] - x) - s(t[k-1] - x)``; the thresholds are the first
    one plus exponentials of free steps, which keeps them in order."""
    rng = np.random.default_rng(seed)
    w = np.zeros(1 << BITS)
    w_sq = np.full(1 << BITS, 1e-6)
    share = np.clip([(grades <= k).mean() for k in range(n_grades - 1)], 0.01, 0.99)
    start = np.log(share / (1 - share))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    f_sq = np.full(len(free), 1e-6)

    def ordered() -> np.ndarray:
        return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])

    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            size = np.array([len(rows[i][0]) for i in pick])
            idx = np.concatenate([rows[i][0] for i in pick])
            value = np.concatenate([rows[i][1] for i in pick])
            x = np.add.reduceat(w[idx] * value, np.cumsum(size) - size)
            t, y = ordered(), grades[pick]
            edge = np.concatenate([[-np.inf], t, [np.inf]])
            hi, lo = _sigmoid(edge[y + 1] - x), _sigmoid(edge[y] - x)
            p = np.maximum(hi - lo, 1e-9)
            d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
            g_x = np.clip((d_hi - d_lo) / p, -1, 1) / len(pick)        # of the loss
            g_w = np.bincount(idx, np.repeat(g_x, size) * value, 1 << BITS)
            w_sq += g_w * g_w
            pace = RATE / np.sqrt(w_sq)
            w -= pace * g_w
            touched = g_w != 0
            w[touched] = np.sign(w[touched]) * np.maximum(np.abs(w[touched]) - SPARSE * pace[touched], 0)
            g_t = np.zeros(len(t))
            up, down = y < len(t), y > 0
            np.add.at(g_t, y[up], -(d_hi / p)[up] / len(pick))
            np.add.at(g_t, y[down] - 1, (d_lo / p)[down] / len(pick))
            g_f = np.concatenate([[g_t.sum()], np.cumsum(g_t[::-1])[::-1][1:] * np.exp(free[1:])])
            f_sq += g_f * g_f
            free -= RATE * g_f / np.sqrt(f_sq)
    return Model(n_grades, w.astype(np.float32), ordered())


class Scorer:
    """Scores of texts; a word's weights are kept in a bounded memo."""

    def __init__(self, model: Model):
        self.model = model
        self.memo: dict[str, tuple[float, float]] = {}

    def _learn(self, words: set[str]) -> dict[str, tuple[float, float]]:
        memo, w = self.memo, self.model.weights.item
        new = [x for x in words if x not in memo]
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list(words)
        found = {}
        for x in new:
            present, shared = word_features(x)
            found[x] = sum(map(w, present)), sum(map(w, shared))
        if len(found) > MEMO or any(len(x) > 64 for x in new):
            return {x: found[x] if x in found else memo[x] for x in words}
        memo.update(found)
        return memo

    def score(self, text: str) -> float:
        words = text.split()
        distinct = set(words)
        table = self._learn(distinct)
        total = float(self.model.weights[text_features(text, words, len(distinct))].sum(dtype=np.float64))
        if distinct:
            present, shared = zip(*map(table.__getitem__, distinct))
            total += math.fsum(present) + SHARE / len(distinct) * math.fsum(shared)
        return total


def fit(docs: DataFrame, ratings: DataFrame, grade: Column, n_grades: int, id_col: str = "doc_id",
        text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Train on documents that have a rating; ``grade`` is a column of
    ``ratings``.  None without ratings or with one grade only.  At most
    ``sample`` different texts are fitted on and collected, also where one id
    has many rows: equal rows count once, the smallest hashes are taken."""
    rated = ratings.select(F.col(id_col).alias("id"), grade.cast("int").alias("grade")).where(
        "id is not null and grade is not null")
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    # only the ids go through the top-n; the texts of those are looked up
    pick = (rated.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
                 .orderBy(F.xxhash64("id"), "id", "grade").limit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("grade"), pa.array([f for f, _ in found], pa.list_(pa.int32())),
                 pa.array([v for _, v in found], pa.list_(pa.float32()))],
                names=["id", "grade", "features", "weight"])

    texts = rows.join(F.broadcast(pick), "id").withColumn("h", F.xxhash64("text"))
    first = (texts.select("id", "grade", "h").distinct().orderBy(F.xxhash64("id"), "id", "grade", "h").limit(sample)
                  .withColumnRenamed("h", "own"))
    chosen = (rows.join(F.broadcast(first), "id").where(F.xxhash64("text") == F.col("own"))
                  .groupBy("id", "grade", "own").agg(F.first("text").alias("text"))
                  .select(F.col("id").cast("string").alias("id"), "grade", "text"))
    got = chosen.mapInArrow(run, "id string, grade int, features array<int>, weight array<float>").toArrow()
    got = got.sort_by([("id", "ascending"), ("grade", "ascending")])
    grades = got.column("grade").to_numpy().astype(np.int64)
    if len(set(grades.tolist())) < 2:
        return None
    each = [(f.values.to_numpy(), v.values.to_numpy()) for f, v in zip(got.column("features"), got.column("weight"))]
    return train(each, grades, n_grades)


def rate(docs: DataFrame, model: Model | None, good: int, id_col: str = "doc_id", text_col: str = "text",
         keep: float = KEEP) -> DataFrame:
    """Every row of ``docs`` with ``expected_grade``, ``tail`` (probability
    of a grade of at least ``good``) and ``kept`` (``tail`` reaches ``keep``)
    behind its own columns, in the struct ``row``."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    if model is None:
        return rows.select("row", F.lit(None).cast("double").alias("expected_grade"),
                           F.lit(None).cast("double").alias("tail"), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType(list(rows.schema)).add("expected_grade", "double").add("tail", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column("row").field(text_col).to_pylist()
            above = scorer.model.above(np.array([scorer.score(t or "") for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(above.sum(axis=1)), pa.array(above[:, good - 1])],
                names=["row", "expected_grade", "tail"])

    out = rows.mapInArrow(run, schema)
    return out.withColumn("kept", F.col("tail") >= keep)
