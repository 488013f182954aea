"""Language identification by a byte convolutional network in numpy.

Bytes are embedded, filters of several widths slide over them, each keeps
its largest response in a window (max pooling), and a softmax over the
pooled responses gives the languages' probabilities.  A text is cut into
windows of fixed length that cover all of it; the windows of many texts
are computed in one batch and a text's probabilities are the mean of its
windows', weighted by their bytes.

Fitting takes a bounded sample: about ``PER_LANG`` documents a language,
chosen by a hash of the id, to the driver.  The fitted network is a few
thousand numbers and is broadcast.

Defined cases: a text that is null or has no letter is ``und`` with score
0; rows with equal ids are predicted one by one; without any labelled text
every prediction is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
PER_LANG = 600        # documents a language that are fitted on, about
WINDOW = 256          # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16          # of each width
DIMS = 8              # of a byte's embedding
STEPS, BATCH, RATE = 700, 64, 0.01
BLOCK = 24            # windows whose responses are held at once

_SPAN = max(WIDTHS)
_PITCH = WINDOW + _SPAN - 1


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray     # DIMS x 256, byte 0 (padding) stays zero
    filters: np.ndarray   # (filters of all widths) x (_SPAN * DIMS)
    bias: np.ndarray
    out: np.ndarray       # filters x languages
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.out_bias]


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, owner, bytes) of windows that cover the texts; each window has
    zeros behind it so that no filter reaches into the next."""
    counts = [-(-len(t) // WINDOW) for t in texts]
    codes = np.zeros((sum(counts), _PITCH), np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    size = np.full(len(codes), WINDOW, np.int64)
    at = 0
    for t, n in zip(texts, counts):
        if n:
            whole, rest = divmod(len(t), WINDOW)
            data = np.frombuffer(t, np.uint8)
            codes[at:at + whole, :WINDOW] = data[:whole * WINDOW].reshape(whole, WINDOW)
            if rest:
                codes[at + whole, :rest] = data[whole * WINDOW:]
                size[at + whole] = rest
            at += n
    return codes, owner, size


def _unfold(net: Network, codes: np.ndarray) -> np.ndarray:
    """Column p holds the embeddings of the bytes p .. p + _SPAN - 1."""
    e = net.embed.take(codes.ravel(), axis=1)
    x = np.zeros((_SPAN * DIMS, e.shape[1]), np.float32)
    for j in range(_SPAN):
        x[j * DIMS:(j + 1) * DIMS, :e.shape[1] - j] = e[:, j:]
    return x


def _respond(net: Network, x: np.ndarray) -> np.ndarray:
    r = net.filters @ x
    return r.reshape(len(r), -1, _PITCH)[:, :, :WINDOW]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def probabilities(net: Network, codes: np.ndarray) -> np.ndarray:
    pooled = np.empty((len(net.filters), len(codes)), np.float32)
    for i in range(0, len(codes), BLOCK):
        pooled[:, i:i + BLOCK] = _respond(net, _unfold(net, codes[i:i + BLOCK])).max(axis=2)
    hidden = np.maximum(pooled + net.bias[:, None], 0)
    return _softmax(hidden.T @ net.out + net.out_bias)


def predict(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probabilities, texts x languages; an empty text has zeros."""
    codes, owner, size = windows(texts)
    sums = np.zeros((len(texts), len(net.langs)))
    np.add.at(sums, owner, probabilities(net, codes) * size[:, None])
    return sums / np.maximum(1, [[len(t)] for t in texts])


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Fit by Adam on random windows, languages drawn equally often."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    codes, owner, _ = windows(texts)
    truth = np.array([langs.index(x) for x in labels])[owner]
    of = [np.flatnonzero(truth == k) for k in range(len(langs))]
    of = [x if len(x) else np.zeros(1, np.int64) for x in of]
    n = len(WIDTHS) * FILTERS
    mask = np.repeat([[j < w for j in range(_SPAN)] for w in WIDTHS], FILTERS, axis=0).repeat(DIMS, axis=1)
    net = Network(langs, rng.normal(0, 0.5, (DIMS, 256)).astype(np.float32),
                  (rng.normal(0, 0.2, (n, _SPAN * DIMS)) * mask).astype(np.float32), np.zeros(n, np.float32),
                  rng.normal(0, 0.2, (n, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    net.embed[:, 0] = 0
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    columns = np.arange(BATCH)
    for step in range(1, STEPS + 1 if len(langs) > 1 and len(codes) else 1):
        want = rng.integers(0, len(langs), BATCH)
        pick = np.array([of[k][rng.integers(len(of[k]))] for k in want])
        x = _unfold(net, codes[pick])
        r = _respond(net, x)
        best = r.argmax(axis=2)                       # filters x windows
        pooled = np.take_along_axis(r, best[:, :, None], 2)[:, :, 0]
        hidden = np.maximum(pooled + net.bias[:, None], 0)
        p = _softmax(hidden.T @ net.out + net.out_bias)
        p[columns, truth[pick]] -= 1
        p /= BATCH
        back = (net.out @ p.T) * (hidden > 0)         # filters x windows
        where = best + columns * _PITCH               # the column each maximum came from
        seen = x[:, where]                            # (_SPAN * DIMS) x filters x windows
        g_filters = np.einsum("fb,kfb->fk", back, seen) * mask
        g_embed = np.zeros_like(net.embed)
        flat = codes[pick].ravel()
        for j in range(_SPAN):
            part = net.filters[:, j * DIMS:(j + 1) * DIMS]
            byte = flat[np.minimum(where + j, len(flat) - 1)].ravel()
            for d in range(DIMS):
                g_embed[d] += np.bincount(byte, (back * part[:, d:d + 1]).ravel(), 256)
        g_embed[:, 0] = 0
        grads = [g_embed, g_filters, back.sum(axis=1), hidden @ p, p.sum(axis=0)]
        for value, g, m, v in zip(net.parts(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG) -> Network | None:
    """Train on about ``per_lang`` rows a language with text and label; None
    without any.  The languages and their counts are collected (one row a
    language), then the sample."""
    rows = docs.where(F.col(text_col).rlike(r"\p{L}") & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    scale = 1 << 30
    chance = F.lit(0)
    for lang, count in sorted(counts.items()):
        chance = F.when(F.col("lang") == lang, F.lit(min(scale, scale * per_lang // count))).otherwise(chance)
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(scale)) < chance)
    got = sorted((r["lang"], r["id"] or "", r["text"]) for r in sample.collect())
    got = got or [(lang, "", "") for lang in counts]
    return train([t.encode("utf-8") for _, _, t in got], [lang for lang, _, _ in got])


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred`` and ``score`` (its probability).  Only the
    text is an input of the prediction."""
    text = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col).cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    if net is None:
        rows = rows.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return rows.withColumnRenamed("id", id_col)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            langs, scores = [], []
            for i in range(0, len(batch), 256):
                texts = batch.column("text").slice(i, 256).to_pylist()
                p = predict(net, [t or b"" for t in texts])
                for t, k, s in zip(texts, p.argmax(axis=1), p.max(axis=1)):
                    langs.append(UNKNOWN if t is None else net.langs[k])
                    scores.append(0.0 if t is None else min(1.0, float(s)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "lang_pred", "score"])

    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
