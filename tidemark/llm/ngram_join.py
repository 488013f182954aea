"""N-gram Jaccard join with a prefix tree, and the components of its links.

A document's set holds the 64-bit hashes of its distinct n-grams, in one
global order: n-grams that many documents share come last, by how many do,
all others come before them by their hash.  Any order gives the same
links; this one keeps common passages from making documents meet.  How
common an n-gram is, is counted over all documents: every batch reports
what at least ``LOCAL`` of its documents share, and the sums over all
batches give the order of the ``COMMON`` most common (broadcast, so
bounded; what lies beyond stays in the order of the hashes).  Documents
with equal sets form a class; one representative of each goes on.

*Which sets can meet.*  Linked sets have at least ``o`` n-grams in common,
and ``o`` is at least ``p`` percent of each size.  So the first n-gram they
share is among the first ``size - o + 1`` of both: every set emits these,
and linked sets emit at least one in common.

*Comparing.*  Sets that emit the same n-gram are compared by a prefix tree:
the sets of a group are stored in the tree by their global order, and a
probe goes down it once, sharing the overlap counted on common prefixes,
and leaves a subtree when its overlap so far plus what remains, of the
probe or of the longest set below, can no longer reach the similarity.

*Before texts travel.*  Every set has a bitmap of about its size in bits,
each n-gram flipping one.  The bits in which two bitmaps differ are at most
the n-grams in which the sets do, so a document whose bitmap is too far
from all others of its group is left out of the comparison, exactly.

*Hot groups.*  Only which documents hang together is asked for, so pairs
that already do are not compared again.  In each of ``ROUNDS`` rounds a
document is compared in the group of one partner for all that it emits (a
hot partner's group is dealt out in blocks, the partner in each); after
that only emitted n-grams whose documents are still in different components
remain, and those are compared exhaustively, block by block.

Defined cases: null and blank texts have no n-grams and link with nothing;
fewer words than ``n`` make one n-gram of the whole sequence; rows with the
same id are one document that has the links of each of its rows; a null id
links with nothing and gets a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_KEYS, materialise, small, whole_text
from tidemark.llm.components import components

N = 3
PERCENT = 90
BLOCK = 256          # sets of a group that one tree holds at most
ROUNDS = 2
LOCAL = 2            # documents of a batch that make an n-gram worth reporting
OFTEN = 4            # reported documents that make it common
TEXT_BYTES = 4 << 20  # text whose sets are described at once, about
COMMON = 1_000_000   # common n-grams that are put in order

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: bytes, n: int = N) -> np.ndarray:
    """The sorted hashes of the distinct n-grams of a UTF-8 text.  ``lower``
    and ``split`` of bytes know ASCII letters and white space only."""
    words = text.lower().split()
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    k = min(n, len(words))
    x = _mix(h[:len(h) - k + 1] + _U(k))
    for i in range(1, k):
        x = _mix(x + h[i:len(h) - k + 1 + i])
    return np.unique(x)


class Order:
    """The global order: n-grams as numbers that sort in it."""

    def __init__(self, common: np.ndarray):
        """``common``: the common n-grams, the rarest first."""
        self.by_value = np.argsort(common, kind="stable")
        self.common = common[self.by_value]

    def put(self, s: np.ndarray) -> np.ndarray:
        out = s >> _U(1)
        if len(self.common) and len(s):
            at = np.minimum(np.searchsorted(self.common, s), len(self.common) - 1)
            hit = self.common[at] == s
            out[hit] = self.by_value[at[hit]].astype(_U) + _U(1 << 63)
            out.sort()
        return out


def emitted(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The n-grams of an ordered set of which linked sets share one."""
    return s[:len(s) - -(-percent * len(s) // 100) + 1] if len(s) else s


def bitmap(s: np.ndarray) -> bytes:
    """A power of two of bits, at least as many as n-grams; each flips one."""
    bits = max(64, 1 << (len(s) - 1).bit_length())
    flips = np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def _folded(maps: np.ndarray) -> np.ndarray:
    """Bitmaps of half the bits, as the same sets would have them."""
    half = maps.shape[1] // 2
    return maps[:, :half] ^ maps[:, half:]


def may_link(sizes: np.ndarray, maps: list[bytes], labels: list, percent: int = PERCENT) -> np.ndarray:
    """Which members of a group may link with one of another label."""
    order = np.argsort(sizes, kind="stable")
    size = sizes[order]
    name = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    label = np.array([name[labels[i]] for i in order])
    width = np.array([len(maps[i]) for i in order])
    out = np.zeros(len(order), bool)
    rows = {w: np.frombuffer(b"".join(maps[i] for i, x in zip(order, width) if x == w), _U).reshape(-1, w // 8)
            for w in dict.fromkeys(width.tolist())}
    begin = {w: int(np.searchsorted(width, w)) for w in rows}  # wider maps belong to larger sets
    half = {w: _folded(m) for w, m in rows.items() if w > 8}
    for i in range(len(order)):
        w = int(width[i])
        mine = rows[w][i - begin[w]]
        to = int(np.searchsorted(size, 100 * size[i] // percent, side="right"))
        for other, table in ((w, rows.get(w)), (2 * w, half.get(2 * w))):
            if table is None:
                continue
            a, b = max(i + 1, begin[other]), min(to, begin[other] + len(table))
            if a >= b:
                continue
            apart = np.bitwise_count(table[a - begin[other]:b - begin[other]] ^ mine).sum(axis=1, dtype=np.int64)
            near = (apart * (100 + percent) <= (size[i] + size[a:b]) * (100 - percent)) & (label[a:b] != label[i])
            if near.any():
                out[i] = True
                out[a:b] |= near
    back = np.empty(len(order), bool)
    back[order] = out
    return back


class Groups:
    """Which members of a group hang together."""

    def __init__(self, labels: list):
        self.up = list(range(len(labels)))
        first: dict = {}
        for i, x in enumerate(labels):
            self.up[i] = first.setdefault(x, i)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


class _Node:
    __slots__ = ("part", "below", "least", "most", "sets")

    def __init__(self, part: np.ndarray, size: int):
        self.part, self.below, self.least, self.most, self.sets = part, {}, size, size, []


class PrefixTree:
    """Sets stored by their global order; shared prefixes are stored once."""

    STEP = 128  # n-grams whose overlap is counted between two looks at the bound

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.top = _Node(np.empty(0, _U), 0)

    def needed(self, a: int, b: int) -> int:
        """Least overlap of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def insert(self, s: np.ndarray, number: int) -> None:
        node, at, size = self.top, 0, len(s)
        while at < size:
            node.least, node.most = min(node.least or size, size), max(node.most, size)
            key = int(s[at])
            child = node.below.get(key)
            if child is None:
                child = node.below[key] = _Node(s[at:], size)
                child.sets.append(number)
                return
            k = min(len(child.part), size - at)
            differ = np.flatnonzero(child.part[:k] != s[at:at + k])
            same = int(differ[0]) if len(differ) else k
            if same < len(child.part):  # split where the set leaves the path
                upper = _Node(child.part[:same], 0)
                upper.least, upper.most = child.least, child.most
                child.part = child.part[same:]
                upper.below[int(child.part[0])] = child
                node.below[key] = child = upper
            node, at = child, at + same
        node.least, node.most = min(node.least, size), max(node.most, size)
        node.sets.append(number)

    def probe(self, s: np.ndarray, number: int, groups: Groups) -> None:
        """Join ``number`` with the sets that it links with, skipping those
        that it hangs together with already."""
        a, p = len(s), self.percent
        low, high = -(-p * a // 100), 100 * a // p
        stack = [(child, 0, 0, 0) for child in self.top.below.values()]
        while stack:
            node, rank, overlap, depth = stack.pop()
            if node.most < low or node.least > high:
                continue
            if not node.below and all(groups.root(x) == groups.root(number) for x in node.sets):
                continue
            need = self.needed(a, max(node.least, low))
            for start in range(0, len(node.part), self.STEP):
                part = node.part[start:start + self.STEP]
                where = np.searchsorted(s, part)
                hit = s[np.minimum(where, a - 1)] == part
                overlap += int(np.count_nonzero(hit))
                depth += len(part)
                rank = int(where[-1]) + int(hit[-1])
                if overlap + min(a - rank, min(node.most, high) - depth) < need:
                    break
            else:
                if node.sets and overlap >= self.needed(a, depth):
                    for x in node.sets:
                        groups.join(x, number)
                stack.extend((child, rank, overlap, depth) for child in node.below.values())


def join_group(sets: list[np.ndarray], labels: list, percent: int = PERCENT) -> Groups:
    """All links among the sets, short sets first, up to hanging together."""
    groups, tree = Groups(labels), PrefixTree(percent)
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        tree.probe(sets[i], i, groups)
        tree.insert(sets[i], i)
    return groups


def common_ngrams(docs: DataFrame, text_col: str, n: int) -> np.ndarray:
    """The most common n-grams, the rarest of them first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = np.concatenate([*(shingles(t.as_buffer().to_pybytes(), n) for t in batch.column("text")), np.empty(0, _U)])
            gram.sort()  # in place: one array of the batch's n-grams at a time
            first = np.flatnonzero(np.concatenate([[len(gram) > 0], gram[1:] != gram[:-1]])[: len(gram)])
            count = np.diff(np.append(first, len(gram)))
            gram = gram[first]
            often = count >= LOCAL
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[often].view(np.int64)), pa.array(count[often].astype(np.int64))], names=["gram", "n"])

    rows = docs.select(whole_text(text_col).cast("binary").alias("text")).mapInArrow(run, "gram long, n long")
    top = (rows.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
               .orderBy(F.desc("n"), F.desc("gram")).limit(COMMON).select("gram").toArrow())
    return top.column("gram").to_numpy()[::-1].view(_U).copy()


def _by_bytes(batches: Iterator[pa.RecordBatch], limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of ``text`` (a longer
    text is a slice of its own)."""
    for batch in batches:
        size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _describe(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int, order) -> DataFrame:
    """(id, n, key, bits, grams) of every row; ``key`` is a 128-bit hash of
    the set, ``bits`` its bitmap, ``grams`` what it emits."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = order.value.put
        for batch in _by_bytes(batches):
            size, key, bits, grams = [], [], [], []
            for text in batch.column("text"):
                s = put(shingles(text.as_buffer().to_pybytes(), n))
                size.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()))
                bits.append(bitmap(s) if len(s) else None)
                grams.append(emitted(s, percent).view(np.int64))
            ends = np.cumsum([0, *map(len, grams)], dtype=np.int32)
            flat = pa.array(np.concatenate([*grams, np.empty(0, np.int64)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(bits, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), flat)],
                names=["id", "n", "key", "bits", "grams"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n long, key binary, bits binary, grams array<long>")


def _by_group(rows: DataFrame, columns: list[str], of_group, schema: str) -> DataFrame:
    """Apply ``of_group`` (lists of the columns -> rows) to each group ``g``.
    Groups are dealt out whole and read in order; one is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, kind = None, [[] for _ in columns], None

        def batch(found: list) -> pa.RecordBatch:
            parts = list(zip(*found)) or [[] for _ in kind]
            return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(parts, kind)], schema=kind)

        for b in batches:
            found = []
            kind = pa.schema([(c, b.schema.field("g" if c == "g" else "id").type) for c in names])
            for g, *values in zip(b.column("g").to_pylist(), *(b.column(c).to_pylist() for c in columns)):
                if g != now:
                    found.extend(of_group(now, *held))
                    now, held = g, [[] for _ in columns]
                for h, v in zip(held, values):
                    h.append(v)
            yield batch(found)
        if kind is not None:
            yield batch(list(of_group(now, *held)))

    names = [x.split()[0] for x in schema.split(", ")]
    return (rows.repartition("g").sortWithinPartitions("g", "id").select("g", *columns).mapInArrow(run, schema))


def _filter(tasks: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The rows of ``tasks(g, id, label)`` that may have a link in their group."""
    def near(g, ids: list, labels: list, sizes: list, maps: list) -> Iterator[tuple]:
        if len(ids) > 1:
            for i in np.flatnonzero(may_link(np.array(sizes), maps, labels, percent)):
                yield g, ids[i], labels[i]

    kind = dict(tasks.dtypes)["id"]
    return _by_group(tasks.join(marks, "id"), ["id", "label", "n", "bits"], near,
                     f"g string, id {kind}, label {kind}").distinct()


def _verify(tasks: DataFrame, texts: DataFrame, n: int, percent: int, order) -> DataFrame:
    """``tasks(g, id, label)``: compare the documents of each group ``g``;
    returns links ``(a, b)`` that span what hangs together."""
    def links(g, ids: list, labels: list, texts: list) -> Iterator[tuple]:
        if len(ids) > 1:
            sets = [order.value.put(shingles(t, n)) for t in texts]
            groups = join_group(sets, labels, percent)
            for i in range(len(ids)):
                if (r := groups.root(i)) != i:
                    yield ids[r], ids[i]

    kind = dict(tasks.dtypes)["id"]
    return _by_group(tasks.join(texts, "id"), ["id", "label", "text"], links, f"a {kind}, b {kind}")


def _blocks(count: str) -> F.Column:
    return F.ceil(F.col(count) / BLOCK).cast("int")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          n: int = N, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Rows ``(id, n, key)`` of all documents, and links ``(a, b)`` between
    representatives (smallest ids) of classes of equal sets, enough to span
    every component."""
    order = docs.sparkSession.sparkContext.broadcast(Order(common_ngrams(docs, text_col, n)))
    described = materialise(_describe(docs, id_col, text_col, n, percent, order), "ngram-sets")
    rows = described.select("id", "n", "key")
    some = described.where("n > 0 and id is not null")
    repeated = materialise(some.groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("rep"))
                               .where("c > 1").select("key", "rep"), "ngram-classes")
    # an id may have several texts and so several sets; each has its class
    reps = (some.join(repeated, "key", "left").where("rep is null or rep = id")
                .select("id", "n", F.explode("grams").alias("gram")))
    # linked sets are of like size: of those that emit an n-gram, only the
    # ones whose next smaller or next larger set is near enough go on
    by_size = W.partitionBy("gram").orderBy("n", "id")
    met = (reps.select("gram", "id", "n", F.lag("n").over(by_size).alias("less"), F.lead("n").over(by_size).alias("more"))
               .where((100 * F.col("less") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("more")))
               .select("gram", "id"))
    met = materialise(met, "ngram-met").distinct()
    # of n-grams with the same documents, one will do
    once = (met.groupBy("gram").agg(F.count("*").alias("c"), F.min("id").alias("lo"),
                                   F.bit_xor(F.xxhash64("id")).alias("x"),
                                   F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
               .groupBy("c", "lo", "x", "y").agg(F.min("gram").alias("gram")).select("gram"))
    met = materialise(met.join(once, "gram"), "ngram-met")

    marks = some.select("id", "n", "bits")
    found = None
    labels = met.select("id", F.col("id").alias("label")).limit(0)
    gram = W.partitionBy("gram")
    for turn in range(ROUNDS + 1):
        known = met.join(labels, "id", "left").select("gram", "id", F.coalesce("label", "id").alias("label"))
        open_ = materialise(
            known.withColumn("lo", F.min("label").over(gram)).withColumn("hi", F.max("label").over(gram))
                 .where("lo < hi").drop("lo", "hi"), "ngram-open")
        if open_.isEmpty():
            break
        if turn < ROUNDS:
            tasks = _partner_tasks(open_, turn)
        else:
            tasks = _all_pairs_tasks(open_)
        tasks = materialise(_filter(tasks, marks, percent), "ngram-tasks")
        ids = materialise(tasks.select("id").distinct(), "ngram-ids")
        texts = (docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
                     .join(small(ids, BROADCAST_KEYS), "id", "left_semi"))
        edges = materialise(_verify(tasks, texts, n, percent, order), "ngram-links")
        found = edges if found is None else found.union(edges)
        labels = components(found)
    if found is None:
        found = met.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    classes = some.join(repeated, "key").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    return rows, found.union(classes)


def _partner_tasks(open_: DataFrame, turn: int) -> DataFrame:
    """Every document with a partner from another component among those it
    shares an emitted n-gram with; the partner changes with ``turn``."""
    gram = W.partitionBy("gram")
    draw = F.struct(F.xxhash64("id", F.lit(turn)).alias("k"), "id", "label") if turn else F.struct(
        F.col("id").alias("k"), "id", "label")
    pairs = (open_.withColumn("p", F.min(draw).over(gram)).where("p.label <> label")
                  .groupBy("id", "label").agg(F.min("p").alias("p"))
                  .select("id", "label", F.col("p.id").alias("partner"), F.col("p.label").alias("plabel")))
    pairs = materialise(pairs, "ngram-pairs")
    size = pairs.groupBy("partner").agg(F.count("*").alias("c"), F.first("plabel").alias("plabel"))
    own = pairs.join(size.select("partner", "c"), "partner").select(
        F.concat_ws("/", "partner", F.pmod(F.xxhash64("id"), _blocks("c"))).alias("g"), "id", "label")
    # the partner itself joins every block of its group
    host = size.select("partner", "plabel", F.explode(F.sequence(F.lit(0), _blocks("c") - 1)).alias("b"))
    host = host.select(F.concat_ws("/", "partner", "b").alias("g"), F.col("partner").alias("id"),
                       F.col("plabel").alias("label"))
    return own.union(host)


def _all_pairs_tasks(open_: DataFrame) -> DataFrame:
    """The documents of every n-gram; those of one with many as pairs of blocks."""
    size = open_.groupBy("gram").agg(F.count("*").alias("c")).select("gram", _blocks("c").alias("k"))
    t = open_.join(size, "gram").withColumn("b", F.pmod(F.xxhash64("id", F.lit(99)), "k").cast("int"))
    t = t.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return t.select(F.concat_ws("/", "gram", F.least("b", "o"), F.greatest("b", "o")).alias("g"), "id", "label")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` and ``component_id``,
    the smallest id that can be reached by links."""
    rows, edges = links(docs, id_col, text_col, n, percent)
    labels = components(edges)
    out = rows.join(labels, "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("label", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the document of the smallest id of every component."""
    found = groups(docs, id_col, text_col, n, percent)
    gone = materialise(found.where(F.col("component_id") != F.col(id_col)).select(id_col).distinct(), "ngram-gone")
    return docs.join(small(gone, BROADCAST_KEYS), id_col, "left_anti").select(*docs.columns)
