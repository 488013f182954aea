"""Nearest neighbours by inner product with vantage-point trees per shard.

*A metric.*  Vectors fall into bands of like norm (``BANDS`` to an octave).
Those of a band are divided by its longest norm and get one more component
that makes their length 1; queries get a zero there and are scaled to 1.
Euclidean distance then orders a band's candidates as the inner product
does, and the triangle inequality holds.  With one band for all, a single
long vector would put every distance near the square root of 2, where a
factor below 1 prunes what is near as well.

*Shards.*  A bounded sample is fitted into a top tree of vantage points for
each band, whose leaves are the shards; every vector falls into one leaf,
and a leaf with more than ``SHARD_ROWS`` vectors is split further by a hash.
A query visits the shards that can hold something with a greater product
than its ``k``-th in the sample, which bounds the true one from below; a
band whose longest vector cannot reach that is left out.

*In a shard.*  A vantage-point tree is built and all of the shard's
queries go down it together; a subtree, and in a leaf a row, is pruned for a
query when the triangle inequality with one of the path's vantage points puts
it farther than ``factor`` times the query's ``k``-th distance so far.  ``factor`` 1 prunes only what cannot matter
and the search is exact; a smaller factor prunes more.  Queries that get
fewer than ``k`` rows that way are searched again with factor 1.

Equal vectors travel as one with their smallest ``k + 1`` ids (no query can
need more), so a vector that a third of all rows share is one candidate
and one query.  Queries of a shard are dealt out in blocks.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, neither do those of another length than most
have (the greater one on a tie); ties go to smaller ids; rows repeating an
id and vector count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

K = 20
FACTOR = 0.6          # of the pruning distance; 1 is exact
SAMPLE = 4096         # vectors the top tree is fitted on, at most
SHARD_ROWS = 4096     # vectors that one tree holds, about
QUERY_BLOCK = 8192    # queries that go down a tree together, about
LEAF = 64             # vectors in a leaf of a tree
BANDS = 2             # bands of norms to an octave


@dataclass
class Node:
    """Inside: distance to the vantage point up to ``radius``."""
    rows: np.ndarray | None = None       # of a leaf
    point: np.ndarray | None = None
    radius: float = 0.0
    inside: Node | None = None
    outside: Node | None = None
    least: list = field(default_factory=list)   # distance ranges of both sides
    number: int = -1                     # of a leaf, in order
    known: np.ndarray | None = None      # of a leaf: its rows' distances to the path's vantage points


def build(x: np.ndarray, leaf: int, seed: int = 1) -> tuple[Node, int]:
    """A tree over the rows of ``x`` and its number of leaves.  The vantage
    point of a node is the one of a few that spreads its rows most."""
    rng = np.random.default_rng(seed)
    leaves = 0

    def grow(rows: np.ndarray, known: np.ndarray) -> Node:
        nonlocal leaves
        if len(rows) > leaf:
            best = None
            for i in rng.choice(rows, 3):
                d = np.linalg.norm(x[rows] - x[i], axis=1)
                if best is None or d.std() > best[0].std():
                    best = d, i
            d, i = best
            radius = float(np.median(d))
            near = d <= radius
            if near.all():
                near = d < radius
                radius = float(np.nextafter(radius, 0))
            if near.any():
                node = Node(point=x[i], radius=radius)
                node.least = [(float(d[near].min()), float(d[near].max())),
                              (float(d[~near].min()), float(d[~near].max()))]
                known = np.concatenate([known, d[:, None]], axis=1)
                node.inside, node.outside = grow(rows[near], known[near]), grow(rows[~near], known[~near])
                return node
        leaves += 1
        return Node(rows=rows, number=leaves - 1, known=known)

    return grow(np.arange(len(x)), np.empty((len(x), 0))), leaves


def assign(tree: Node, x: np.ndarray) -> np.ndarray:
    """The leaf that each row of ``x`` falls into."""
    out = np.empty(len(x), np.int64)

    def go(node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.rows is not None:
            out[rows] = node.number
            return
        near = np.linalg.norm(x[rows] - node.point, axis=1) <= node.radius
        go(node.inside, rows[near])
        go(node.outside, rows[~near])

    go(tree, np.arange(len(x)))
    return out


def reach(tree: Node, q: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) pairs: leaves whose space comes within ``limit`` of the
    query.  Space, not the fitted rows: other rows fall into it as well."""
    queries, leaves = [], []

    def go(node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.rows is not None:
            queries.append(rows)
            leaves.append(np.full(len(rows), node.number))
            return
        d = np.linalg.norm(q[rows] - node.point, axis=1)
        go(node.inside, rows[d - node.radius <= limit[rows]])
        go(node.outside, rows[node.radius - d <= limit[rows]])

    go(tree, np.arange(len(q)))
    return np.concatenate([*queries, np.empty(0, np.int64)]), np.concatenate([*leaves, np.empty(0, np.int64)])


def search(x: np.ndarray, q: np.ndarray, k: int, factor: float, limit: np.ndarray,
           seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows of ``x``, distances), queries x k, -1 where there are fewer.
    ``limit`` bounds each query's k-th distance from above.  What bounds a
    subtree, and in a leaf each row, from below is the greatest that any
    vantage point on the path gives.  ``seen`` gets the number of (query, row)
    pairs that no bound leaves out."""
    tree, _ = build(x, LEAF)
    ids = np.full((len(q), k), -1, np.int64)
    dist = np.full((len(q), k), np.inf)
    q_sq, x_sq = (q * q).sum(axis=1), (x * x).sum(axis=1)

    def bound(rows: np.ndarray) -> np.ndarray:
        return factor * np.minimum(dist[rows, -1], limit[rows])

    def look(node: Node, rows: np.ndarray, path: list[np.ndarray]) -> None:
        most, can = bound(rows)[:, None] + 1e-9, np.ones((len(rows), len(node.rows)), bool)
        for mine, theirs in zip(path, node.known.T):
            can &= np.abs(mine[:, None] - theirs[None]) <= most
        if seen is not None:
            seen.append(int(can.sum()))
        some = can.any(axis=1)
        rows, can = rows[some], can[some]
        if not len(rows):
            return
        d = np.sqrt(np.maximum(0, q_sq[rows, None] + x_sq[None, node.rows] - 2 * (q[rows] @ x[node.rows].T)))
        d = np.where(can, d, np.inf)
        all_d = np.concatenate([dist[rows], d], axis=1)
        all_i = np.concatenate([ids[rows], np.broadcast_to(node.rows, d.shape)], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :k]
        dist[rows] = np.take_along_axis(all_d, order, 1)
        ids[rows] = np.where(np.isinf(dist[rows]), -1, np.take_along_axis(all_i, order, 1))

    def go(node: Node, rows: np.ndarray, above: np.ndarray, path: list[np.ndarray]) -> None:
        if not len(rows):
            return
        if node.rows is not None:
            look(node, rows, path)
            return
        d = np.linalg.norm(q[rows] - node.point, axis=1)
        sides = (node.inside, node.outside)
        (in_lo, in_hi), (out_lo, out_hi) = node.least
        # by the triangle inequality nothing on a side is nearer than this
        low = (np.maximum(above, np.maximum(d - in_hi, in_lo - d)), np.maximum(above, np.maximum(d - out_hi, out_lo - d)))
        first = (d > node.radius).astype(np.int64)
        for turn in (0, 1):
            for side in (0, 1):  # the nearer side first, then the other one
                mine = (first == side) if turn == 0 else (first != side)
                mine &= low[side] <= bound(rows) + 1e-9
                go(sides[side], rows[mine], low[side][mine], [p[mine] for p in [*path, d]])

    go(tree, np.arange(len(q)), np.zeros(len(q)), [])
    return ids, dist


def _usable(vector: str) -> Column:
    """As array of double; null if it takes no part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.when(fine & F.exists(v, lambda c: c != 0), v)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _lift(x: np.ndarray, longest: np.ndarray | float) -> np.ndarray:
    x = x / np.reshape(longest, (-1, 1))
    extra = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
    return np.concatenate([x, extra[:, None]], axis=1)


def _lift_query(q: np.ndarray) -> np.ndarray:
    return np.concatenate([q / np.linalg.norm(q, axis=1)[:, None], np.zeros((len(q), 1))], axis=1)


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = K, factor: float = FACTOR, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each row that ``is_query`` (of the id) holds for, its ``k``
    nearest other rows: ``query_id``, ``rank`` from 1, the id, ``score``
    (inner product)."""
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    clean = (rows.select(F.col(id_col).alias("id"), _usable(vector_col).alias("v"))
                 .where("id is not null and v is not null").withColumn("dims", F.size("v")))
    clean = materialise(clean, "ann-rows")
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score double")
    dims = clean.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not dims:
        return empty
    clean = clean.where(F.col("dims") == dims[0]["dims"]).drop("dims").dropDuplicates(["id", "v"])

    # equal vectors as one, with their smallest ids; the row number stops
    # each input partition at k + 1 rows a vector before the shuffle
    query = is_query
    by_id = W.partitionBy("v").orderBy("id")
    few = clean.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
    distinct = materialise(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                              .withColumn("key", F.element_at("ids", 1)), "ann-vectors")
    asked = materialise(clean.where(query).join(distinct.select("v", "key"), "v").select("id", "key"), "ann-asked")
    wanted = distinct.join(asked.select("key").distinct(), "key").select("key", "v")

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
    # 1 is in the middle of a band, so rounding does not split unit vectors
    banded = distinct.withColumn("norm", norm).withColumn(
        "band", F.floor(F.log2("norm") * BANDS + 0.5).cast("int"))
    # one row a band, of which there are as many as octaves of a double at most
    held = banded.groupBy("band").agg(F.max("norm").alias("longest"), F.count("*").alias("n")).orderBy("band").collect()
    longest = {r["band"]: r["longest"] for r in held}
    count = sum(r["n"] for r in held)
    fitted = banded.orderBy(F.xxhash64("key"), "key").limit(sample).select("key", "v", "band").toArrow()
    order = np.argsort(fitted.column("key").to_numpy(), kind="stable")
    points = _matrix(fitted.column("v").combine_chunks())[order]
    of_point = fitted.column("band").to_numpy()[order]
    # a band without a vector in the sample is small: one shard
    trees, shards = {}, 0
    for band in longest:
        mine = _lift(points[of_point == band], longest[band])
        leaf = max(1, min(len(points), -(-len(points) * shard_rows // count)))
        tree, leaves = build(mine, leaf)
        trees[band] = tree, shards
        shards += leaves
    shared = spark.sparkContext.broadcast((trees, points, longest))
    inside = f"shard int, key {kind}, v array<double>"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, _, longest = shared.value
        for b in batches:
            shard = np.empty(len(b), np.int64)
            bands = b.column("band").to_numpy()
            for band in np.unique(bands).tolist():
                mine = np.flatnonzero(bands == band)
                tree, start = trees[band]
                shard[mine] = start + assign(tree, _lift(_matrix(b.column("v").take(pa.array(mine))), longest[band]))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *b.columns], names=["shard", *b.schema.names])

    def visit(factor: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, points, longest = shared.value
        need = k + 1
        for b in batches:
            if not len(b):
                continue
            y = _matrix(b.column("v"))
            q = _lift_query(y)
            # the product of the direction with the k-th in the sample
            least = np.full(len(q), -np.inf)
            if len(points) >= need:
                for i in range(0, len(q), 512):
                    s = q[i:i + 512, :-1] @ points.T
                    least[i:i + 512] = -np.partition(-s, need - 1, axis=1)[:, need - 1]
            for band, (tree, start) in trees.items():
                within = least / longest[band]
                can = np.flatnonzero(within <= 1 + 1e-9)
                if not len(can):
                    continue
                limit = np.sqrt(np.maximum(0, 2 - 2 * within[can])) + 1e-7
                who, shard = reach(tree, q[can], factor * limit)
                pick = pa.array(can[who])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(start + shard, pa.int32()), b.column("key").take(pick), b.column("v").take(pick),
                     pa.array(limit[who])], names=["shard", "key", "v", "limit"])

    placed = banded.select("key", "ids", "v", "band").mapInArrow(
        place, f"shard int, key {kind}, ids array<{kind}>, v array<double>, band int")
    placed = materialise(placed, "ann-placed")
    group = ["shard", "part", "block"]

    def probe(wanted: DataFrame, factor: float) -> DataFrame:
        """The ``k + 1`` best (key, id, score) of every vector asked for."""
        visits = materialise(wanted.mapInArrow(partial(visit, factor), inside + ", limit double"), "ann-visits")
        # a shard that holds much is split by a hash, its queries by another one
        load = (placed.groupBy("shard").agg(F.count("*").alias("n"))
                      .join(visits.groupBy("shard").agg(F.count("*").alias("m")), "shard")
                      .select("shard", F.ceil(F.col("n") / (2 * shard_rows)).cast("int").alias("parts"),
                              F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("blocks")))
        load = materialise(load, "ann-load")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = (placed.join(load, "shard").withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int"))
                      .withColumn("block", every("blocks")).select("shard", "part", "block", "key", "ids", "v", "band",
                                                                  F.lit(None).cast("double").alias("limit")))
        right = (visits.join(load, "shard")
                       .withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), "blocks").cast("int"))
                       .withColumn("part", every("parts"))
                       .select("shard", "part", "block", "key", F.lit(None).cast(f"array<{kind}>").alias("ids"), "v",
                               F.lit(None).cast("int").alias("band"), "limit"))

        def run(table: pa.Table) -> pa.Table:
            is_candidate = table.column("limit").is_null()
            c, q = table.filter(is_candidate), table.filter(table.column("limit").is_valid())
            schema = pa.schema([("key", c.schema.field("key").type), ("ids", c.schema.field("ids").type),
                                ("score", pa.float64())])
            if not len(c) or not len(q):
                return schema.empty_table()
            _, _, longest = shared.value
            x, y = _matrix(c.column("v").combine_chunks()), _matrix(q.column("v").combine_chunks())
            found, _ = search(_lift(x, longest[c.column("band")[0].as_py()]), _lift_query(y), min(k + 1, len(c)),
                              factor, q.column("limit").to_numpy())
            who, at = np.nonzero(found >= 0)
            hit = found[who, at]
            score = np.einsum("ij,ij->i", x[hit], y[who])
            return pa.table([q.column("key").take(pa.array(who)), c.column("ids").take(pa.array(hit)),
                             pa.array(score)], schema=schema)

        hits = left.unionByName(right).groupBy(*group).applyInArrow(
            run, f"key {kind}, ids array<{kind}>, score double")
        best = W.partitionBy("key").orderBy(F.desc("score"), "id")
        near = (hits.select("key", F.explode("ids").alias("id"), "score")
                    .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"))
        return materialise(near, "ann-near")

    near = probe(wanted, factor)
    if factor < 1:
        full = near.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > k).select("key")
        few = materialise(wanted.join(full, "key", "left_anti"), "ann-few")
        if not few.isEmpty():
            near = near.join(few.select("key"), "key", "left_anti").unionByName(probe(few, 1.0))
    # every asking id gets its vector's list, without itself
    rank = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    out = (asked.select(F.col("id").alias("query_id"), "key").join(near, "key").where("id <> query_id")
                .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k))
    return out.select("query_id", "rank", F.col("id").alias(id_col), "score")
