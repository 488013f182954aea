"""Hard negatives by inner product with STR-packed R-trees.

For each anchor its ``positives`` best rows of the same label are found, then
for each of them the best rows of other labels whose product with the anchor
lies in a window given in hundredths of the positive's.

*Trees.*  Rows are sorted by label, cut into slabs, these sorted by the
coordinate that varies most and cut again, then by the next one (sort, tile,
recurse), so that leaves are full and their boxes small; boxes of ``FAN``
neighbours make the next level.  From the least and greatest value of every
coordinate a box gives an interval of the inner products with an anchor.

*Search.*  The anchors of a task go down a tree together.  A queue holds boxes
with the anchors that still need them, best possible product first; an anchor
leaves a box out when the interval misses its window, when the labels in the
box are not wanted, or when even the greatest product is strictly below its
``k``-th so far.

*On the cluster.*  A bounded sample (``SAMPLE``) gives the same kind of tiling
for the whole table; every row is put into its tile, and a tile of many rows
(equal vectors too) is split by a hash of the id.  Each anchor's ``k``-th in the
sample bounds its true one from below, and it visits only tiles whose boxes,
taken over all their rows, can matter.  Anchors of a tile are dealt out in
blocks.  Vectors whose boxes overlap widely leave little to prune; then every
anchor meets every row, in blocks.

Defined cases: rows with a null id, label or vector or a null or non-finite
component take no part, neither do vectors of another length than most have
(the greater one on a tie), with a quantised component from 2^32 on or a
squared length from 2^62 on, so products fit 64 bits; of rows with one id the one with the
smallest label, then vector, counts; ties go to smaller ids; anchors without
a positive, and positives without a row in the window, give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_KEYS, materialise, small

POSITIVES, NEGATIVES = 5, 3
WINDOW = 50, 95        # hundredths of the positive's score
SAMPLE = 4096          # rows the tiles are fitted on, at most
TILE_ROWS = 8192       # rows of a tree, about
TILES = 1024           # at most; larger tiles are split by a hash
BLOCK = 4096           # anchors that go down a tree together, about
LEAF, FAN = 64, 8
NONE = np.int64(-(1 << 62))
MOST = np.int64(1 << 62)


# --- the tree -----------------------------------------------------------------------

@dataclass
class Level:
    """Boxes of one level; those of the level below begin at ``start``."""
    low: np.ndarray
    high: np.ndarray
    labels: np.ndarray   # least and greatest label
    start: np.ndarray


def slabs(keys: list[np.ndarray], rows: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Sort, tile, recurse: ``rows`` cut into leaves by ``keys`` in turn."""
    leaves = -(-len(rows) // leaf)
    if leaves <= 1:
        return [rows]
    rows = rows[np.lexsort((rows, keys[0][rows]))]
    pieces = leaves if len(keys) == 1 else int(np.ceil(leaves ** (1 / len(keys))))
    size = leaf if len(keys) == 1 else -(-leaves // pieces) * leaf
    cut = [rows[i:i + size] for i in range(0, len(rows), size)]
    return cut if len(keys) == 1 else [x for c in cut for x in slabs(keys[1:], c, leaf)]


def sort_keys(x: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    return [labels, *(x[:, j] for j in np.argsort(-x.var(axis=0), kind="stable")[:2])]


def build(x: np.ndarray, labels: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> tuple[np.ndarray, list[Level]]:
    """The rows in order of their leaves, and the levels, leaves first."""
    leaves = slabs(sort_keys(x, labels), np.arange(len(x)), leaf)
    order = np.concatenate(leaves)
    start = np.cumsum([0, *map(len, leaves[:-1])])
    low, high, least, most = x[order], x[order], labels[order], labels[order]
    levels = []
    while True:
        low, high = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
        least, most = np.minimum.reduceat(least, start), np.maximum.reduceat(most, start)
        levels.append(Level(low, high, np.stack([least, most]), start))
        if len(start) == 1:
            return order, levels
        start = np.arange(0, len(start), fan)


def interval(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each query with what is in each box;
    a little wider, for rounding."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
    return least - 1 - 1e-9 * np.abs(least), most + 1 + 1e-9 * np.abs(most)


def products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products: doubles hold them up to 2^53."""
    return (q @ x.T).astype(np.int64) if exact else q.astype(np.int64) @ x.astype(np.int64).T


@dataclass
class Asked:
    """Windows of anchors: ``of`` names the anchor of each."""
    q: np.ndarray         # vectors of the anchors
    ids: np.ndarray
    labels: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray     # no window's k-th score is below

    def wants(self, some: np.ndarray, labels: np.ndarray, same: bool) -> np.ndarray:
        """windows x boxes: boxes with a label that is wanted."""
        mine = self.labels[self.of[some], None]
        if same:
            return (labels[0] <= mine) & (mine <= labels[1])
        return (labels[0] != mine) | (labels[1] != mine)


def search(x: np.ndarray, labels: np.ndarray, ids: np.ndarray, asked: Asked, k: int, same: bool,
           exact: bool, seen: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, row, score) of the ``k`` best of each window.  ``seen`` gets
    the number of products worked out."""
    order, levels = build(x, labels)
    m = len(asked.of)
    score, best = np.full((m, k), NONE), np.full((m, k), -1)

    def kth(some: np.ndarray) -> np.ndarray:
        return np.maximum(score[some, -1], asked.floor[some])

    def look(rows: np.ndarray, some: np.ndarray) -> None:
        who, at = np.unique(asked.of[some], return_inverse=True)
        got = products(asked.q[who], x[rows], exact)[at]
        if seen is not None:
            seen.append(len(who) * len(rows))
        mine = asked.of[some]
        fine = (got >= asked.low[some, None]) & (got <= asked.high[some, None]) & (got >= kth(some)[:, None])
        fine &= (labels[rows][None] == asked.labels[mine, None]) == same
        fine &= ids[rows][None] != asked.ids[mine, None]
        w, r = np.nonzero(fine)
        if not len(w):
            return
        hit = np.unique(w)
        was, old = np.nonzero(best[some[hit]] >= 0)
        w_all = np.concatenate([some[w], some[hit][was]])
        s_all = np.concatenate([got[w, r], score[some[hit][was], old]])
        r_all = np.concatenate([rows[r], best[some[hit][was], old]])
        place = np.lexsort((ids[r_all], -s_all, w_all))
        w_all, s_all, r_all = w_all[place], s_all[place], r_all[place]
        _, begin, count = np.unique(w_all, return_index=True, return_counts=True)
        rank = np.arange(len(w_all)) - np.repeat(begin, count)
        top = rank < k
        score[w_all[top], rank[top]], best[w_all[top], rank[top]] = s_all[top], r_all[top]

    def bounds(level: Level, at: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        who, back = np.unique(asked.of[some], return_inverse=True)
        least, most = interval(asked.q[who], level.low[at], level.high[at])
        least, most = least[back], most[back]
        fine = (most >= kth(some)[:, None]) & (most >= asked.low[some, None]) & (least <= asked.high[some, None])
        return fine & asked.wants(some, level.labels[:, at], same), np.minimum(most, asked.high[some, None])

    queue, number = [], 0

    def push(depth: int, at: np.ndarray, some: np.ndarray) -> None:
        nonlocal number
        fine, key = bounds(levels[depth], at, some)
        for j in np.flatnonzero(fine.any(axis=0)):
            mine = fine[:, j]
            number += 1
            heapq.heappush(queue, (-key[mine, j].max(), number, depth, int(at[j]), some[mine], key[mine, j]))

    push(len(levels) - 1, np.array([0]), np.arange(m))
    while queue:
        _, _, depth, at, some, key = heapq.heappop(queue)
        some = some[key >= kth(some)]
        if not len(some):
            continue
        start = levels[depth].start
        stop = start[at + 1] if at + 1 < len(start) else (len(x) if depth == 0 else len(levels[depth - 1].start))
        if depth == 0:
            look(order[start[at]:stop], some)
        else:
            push(depth - 1, np.arange(start[at], stop), some)
    window, rank = np.nonzero(best >= 0)
    return window, best[window, rank], score[window, rank]


# --- tiles of the whole table -----------------------------------------------------------

@dataclass
class Tiling:
    """Cuts by label and two coordinates, in turn; numbers the tiles."""
    axis: int = 0                     # 0 is the label
    cuts: np.ndarray | None = None
    below: list | None = None
    number: int = -1


def fit(x: np.ndarray, tiles: int) -> tuple[Tiling, int]:
    """``x`` has the label as its first column."""
    axes = [0, *(1 + np.argsort(-x[:, 1:].var(axis=0), kind="stable")[:2])] if len(x) else [0]
    made = 0

    def grow(rows: np.ndarray, axes: list, tiles: int) -> Tiling:
        nonlocal made
        if tiles <= 1 or not axes or len(rows) < 2:
            made += 1
            return Tiling(number=made - 1)
        pieces = min(len(rows), tiles if len(axes) == 1 else int(np.ceil(tiles ** (1 / len(axes)))))
        values = np.sort(x[rows, axes[0]])
        cuts = np.unique(values[[len(values) * i // pieces for i in range(1, pieces)]])
        part = np.searchsorted(cuts, x[rows, axes[0]], side="right")
        each = -(-tiles // pieces)
        return Tiling(int(axes[0]), cuts, [grow(rows[part == i], axes[1:], each) for i in range(len(cuts) + 1)])

    return grow(np.arange(len(x)), axes, tiles), made


def tile_of(tiling: Tiling, x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int32)

    def go(node: Tiling, rows: np.ndarray) -> None:
        if node.below is None:
            out[rows] = node.number
            return
        part = np.searchsorted(node.cuts, x[rows, node.axis], side="right")
        for i, child in enumerate(node.below):
            go(child, rows[part == i])

    go(tiling, np.arange(len(x)))
    return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _labelled(batch) -> np.ndarray:
    return np.concatenate([batch.column("label").to_numpy()[:, None], _matrix(batch.column("v"))], axis=1)


def _place(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tile = tile_of(shared.value[0], _labelled(b)) if len(b) else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(tile), *b.columns], names=["tile", *b.schema.names])


def _extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tile, axis, low, high); axis 0 is the label."""
    for b in batches:
        if not len(b):
            continue
        x, tile = _labelled(b), b.column("tile").to_numpy()
        order = np.argsort(tile, kind="stable")
        which, start = np.unique(tile[order], return_index=True)
        low, high = (f.reduceat(x[order], start) for f in (np.minimum, np.maximum))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(which, x.shape[1])), pa.array(np.tile(np.arange(x.shape[1], dtype=np.int32), len(which))),
             pa.array(low.ravel()), pa.array(high.ravel())], names=["tile", "axis", "low", "high"])


_ASK = "id long, label long, v array<double>, keys array<long>, lows array<long>, highs array<long>"


def _windows(b) -> Asked:
    keys = b.column("keys")
    count = np.diff(keys.offsets.to_numpy())
    flat = [b.column(c).flatten().to_numpy() for c in ("lows", "highs")]
    floor = b.column("floors").flatten().to_numpy() if "floors" in b.schema.names else np.full(len(flat[0]), NONE)
    return Asked(_matrix(b.column("v")), b.column("id").to_numpy(), b.column("label").to_numpy(),
                 np.repeat(np.arange(len(b)), count), *flat, floor)


def _visit(shared, k: int, same: bool, exact: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with the tiles that they must see and their windows' floors."""
    _, points, labels, ids, (tiles, low, high) = shared.value
    level = Level(low[:, 1:], high[:, 1:], np.stack([low[:, 0], high[:, 0]]), tiles)
    for whole in batches:
        for i in range(0, len(whole), 256):
            b = whole.slice(i, 256)
            asked = _windows(b)
            got = products(asked.q, points, exact)[asked.of]
            mine = asked.of
            fine = (got >= asked.low[:, None]) & (got <= asked.high[:, None])
            fine &= ((labels[None] == asked.labels[mine, None]) == same) & (ids[None] != asked.ids[mine, None])
            got = np.where(fine, got, NONE)
            floor = -np.partition(-got, k - 1, axis=1)[:, k - 1] if got.shape[1] >= k else asked.floor
            least, most = interval(asked.q, level.low, level.high)
            need = (most[mine] >= floor[:, None]) & (most[mine] >= asked.low[:, None]) & (least[mine] <= asked.high[:, None])
            need &= asked.wants(np.arange(len(mine)), level.labels, same)
            per = np.zeros((len(b), len(tiles)), bool)
            np.logical_or.at(per, mine, need)
            who, tile = np.nonzero(per)
            keys = b.column("keys")
            ends = pa.array(np.concatenate([[0], np.cumsum(np.diff(keys.offsets.to_numpy()))]).astype(np.int32))
            floors = pa.ListArray.from_arrays(ends, pa.array(floor))
            pick = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tiles[tile]), *(b.column(c).take(pick) for c in b.schema.names), floors.take(pick)],
                names=["tile", *b.schema.names, "floors"])


def _probe(k: int, same: bool, exact: bool):
    def run(table: pa.Table) -> pa.Table:
        is_row = table.column("keys").is_null()
        rows, asks = table.filter(is_row), table.filter(pc.invert(is_row))
        names = ["anchor", "key", "id", "score"]
        if not len(rows) or not len(asks):
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        asks = asks.combine_chunks().to_batches()[0]
        asked, ids = _windows(asks), rows.column("id").to_numpy()
        window, row, score = search(_matrix(rows.column("v").combine_chunks()), rows.column("label").to_numpy(), ids,
                                    asked, k, same, exact)
        keys = asks.column("keys").flatten().to_numpy()
        return pa.table([asked.ids[asked.of[window]], keys[window], ids[row], score], names=names)
    return run


def _clean(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column, scale: int) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    # floor() of a double is a long, which a great component does not fit
    whole = F.transform(v, lambda c: F.when(F.abs(c) * scale < 2.0 ** 32, F.floor(c * scale).cast("double"))
                                      .otherwise(F.lit(float("inf"))))
    clean = (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                         F.when(fine, whole).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
                 .where("id is not null and label is not null and v is not null")
                 .withColumn("square", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
                 .where(F.col("square") < 2.0 ** 62).withColumn("dims", F.size("v")))
    return materialise(clean, "negatives-rows")


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, scale: int = 256, sample: int = SAMPLE,
         tile_rows: int = TILE_ROWS) -> DataFrame:
    """For each row that ``anchor`` holds for and each of its positives the
    ``negatives`` best rows in the window: ``anchor_id``, ``positive_id``,
    ``rank`` from 1, ``negative_id``, ``positive_score``, ``negative_score``.
    Components are quantised to ``floor(scale * x)``."""
    spark = rows.sparkSession
    clean = _clean(rows, id_col, vector_col, F.col("label") if label is None else label, anchor, scale)
    dims = clean.groupBy("dims").agg(F.count("*").alias("n"), F.max("square").alias("square"))
    most = dims.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not most or not most[0]["dims"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    clean, exact = clean.where(F.col("dims") == most[0]["dims"]).drop("dims", "square"), most[0]["square"] < 2.0 ** 52
    twice = materialise(clean.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "negatives-twice")
    if not twice.isEmpty():
        held = small(twice, BROADCAST_KEYS)
        one = (clean.join(held, "id", "left_semi").groupBy("id")
                    .agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("id", "r.*"))
        clean = materialise(clean.join(held, "id", "left_anti").unionByName(one), "negatives-rows")

    fitted = clean.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "label", "v").toArrow().combine_chunks()
    batch = fitted.to_batches()[0]
    tiling, _ = fit(_labelled(batch), min(TILES, -(-most[0]["n"] // tile_rows)))
    known = (tiling, _matrix(batch.column("v")), batch.column("label").to_numpy(), batch.column("id").to_numpy())
    shared = spark.sparkContext.broadcast(known)
    placed = materialise(clean.mapInArrow(partial(_place, shared), "tile int, id long, label long, v array<double>, anchor boolean"),
                         "negatives-placed")
    # at most TILES x components rows
    boxes = (placed.select("tile", "label", "v").mapInArrow(_extents, "tile int, axis int, low double, high double")
                   .groupBy("tile", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high"))
                   .orderBy("tile", "axis").toArrow())
    tiles = np.unique(boxes.column("tile").to_numpy())
    sides = [boxes.column(c).to_numpy().reshape(len(tiles), -1) for c in ("low", "high")]
    shared = spark.sparkContext.broadcast((*known, (tiles, *sides)))

    def best(asks: DataFrame, k: int, same: bool) -> DataFrame:
        visits = materialise(asks.mapInArrow(partial(_visit, shared, k, same, exact), "tile int, " + _ASK + ", floors array<long>"),
                             "negatives-visits")
        load = (placed.groupBy("tile").agg(F.count("*").alias("n"))
                      .join(visits.groupBy("tile").agg(F.count("*").alias("m")), "tile")
                      .select("tile", F.ceil(F.col("n") / (2 * tile_rows)).cast("int").alias("parts"),
                              F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
        load = materialise(load, "negatives-load")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = (placed.drop("anchor").join(small(load), "tile").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
                      .withColumn("block", each("blocks")))
        right = (visits.join(small(load), "tile").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), "blocks").cast("int"))
                       .withColumn("part", each("parts")))
        both = left.unionByName(right, allowMissingColumns=True).drop("parts", "blocks")
        hits = both.groupBy("tile", "part", "block").applyInArrow(
            _probe(k, same, exact), "anchor long, key long, id long, score long")
        order = W.partitionBy("anchor", "key").orderBy(F.desc("score"), "id")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    asks = placed.where("anchor").select(
        "id", "label", "v", F.array("id").alias("keys"), F.array(F.lit(int(NONE))).alias("lows"),
        F.array(F.lit(int(MOST))).alias("highs"))
    near = materialise(best(asks, positives, same=True).select("anchor", F.col("id").alias("positive"), "score"), "negatives-positives")
    # whole hundreds apart, so that no product passes 64 bits
    hundreds = F.expr("(score - pmod(score, 100)) div 100")
    low = hundreds * window[0] + F.expr(f"(pmod(score, 100) * {window[0]} + 99) div 100")
    high = hundreds * window[1] + F.expr(f"(pmod(score, 100) * {window[1]}) div 100")
    spans = (near.select("anchor", F.struct("positive", low.alias("low"), high.alias("high")).alias("s")).where("s.low <= s.high")
                 .groupBy("anchor").agg(F.sort_array(F.collect_list("s")).alias("s"))
                 .select(F.col("anchor").alias("id"), F.col("s.positive").alias("keys"), F.col("s.low").alias("lows"),
                         F.col("s.high").alias("highs")))
    asks = placed.where("anchor").select("id", "label", "v").join(spans, "id")
    found = best(asks, negatives, same=False)
    scores = near.select("anchor", F.col("positive").alias("key"), F.col("score").alias("positive_score"))
    return found.join(scores, ["anchor", "key"]).select(
        F.col("anchor").alias("anchor_id"), F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
