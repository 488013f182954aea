"""Mix sources to target weights with hash-threshold histograms.

Every document has a stable hash.  Words are summed by (source, hash
bucket); the histogram's running sum shows in which bucket a source's
budget runs out, only that bucket is split into finer ones by the next
hash bits, and after ``LEVELS`` rounds a document is taken when its hash
lies below its source's threshold.  No row is sorted, and what is windowed
is the histogram (at most ``2**BITS`` rows a source).

A budget may exceed its source: the whole multiples of the source's size
are taken from every document, the hash threshold decides the rest, so the
thresholds of a smaller and a larger budget are nested.

Defined cases: a null text has size 0; sources are ranked by code point
with null last; a null id is hashed by its text; rows that repeat an id (null
too) are hashed by id, whole row and their number among equal rows, so that a
part of them can be taken; a source without words has target 0 and takes 0.  The sources (not the rows)
are ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_KEYS, materialise, small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)   # by rank of the source, repeating
MAX_EPOCHS = 3        # a target stops at so many times its source
BITS = 12             # buckets a source and round: 4096
LEVELS = 4            # rounds of refinement, 48 hash bits in all
NUMBERED = 1_000_000  # equal rows that a task numbers


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _bits(key: Column) -> Column:
    """48 stable bits: the first 12 hex digits of an md5."""
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long")


def row_hash(id_col: str, text_col: str) -> Column:
    return _bits(F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col)), F.lit("")))


def _repeated(rows: DataFrame) -> DataFrame | None:
    """The ids of more than one of the (narrow) rows."""
    twice = materialise(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
                            .select(F.col("id").alias("_again")), "mix-repeated")
    return None if twice.isEmpty() else twice


def _numbered(docs: DataFrame, twice: DataFrame, id_col: str) -> DataFrame:
    """The rows of repeated ids as ``_row`` with their ``hash``: equal rows
    are counted first and then numbered, so none gathers in a task."""
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names])
    rows = docs.join(small(twice, BROADCAST_KEYS), F.col(id_col).eqNullSafe(F.col("_again")), "left_semi")
    rows = rows.select(whole.alias("_row"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key"))
    rows = rows.withColumn("_key", F.concat_ws("/", "_key", F.md5(F.to_json("_row", {"ignoreNullFields": "false"}))))
    rows = materialise(rows.groupBy("_key").agg(F.first("_row").alias("_row"), F.count("*").alias("_n")), "mix-equal")
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {NUMBERED}")))
    number = F.explode(F.sequence(F.col("_b") * NUMBERED, F.least((F.col("_b") + 1) * NUMBERED, F.col("_n")) - 1))
    each = rows.select("_key", "_n").withColumn("_b", block).repartition("_key", "_b").withColumn("_i", number)
    each = each.select("_key", "_i").join(rows.select("_key", "_row"), "_key")
    return each.select("_row", _bits(F.concat_ws("/", "_key", F.col("_i").cast("string"))).alias("hash"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size)`` -> with ``target``.

    The shares by weight, each stopped at ``max_epochs`` times its source
    and the excess reshared, settle where the sources with the smallest
    size a weight are the stopped ones; one ordered pass over the sources
    finds them.  The table has one row a source.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                          (rank % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * max_epochs
    t = sizes.withColumn("_w", weight).withColumn("_cap", cap)
    order = W.orderBy((F.col("_cap").cast("double") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    w_left = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    t = t.withColumn("_left", left).withColumn("_wleft", w_left)
    # the first source in this order that its share does not stop, if any
    free = F.col("_cap") * F.col("_wleft") > F.col("_left") * F.col("_w")
    t = t.withColumn("_free", F.min(F.when(free, F.struct((F.col("_cap").cast("double") / F.col("_w")).alias("k"),
                                                          F.col("_left").alias("l"), F.col("_wleft").alias("w")))).over(everything))
    share = F.col("_free.l").cast("double") * F.col("_w") / F.col("_free.w")
    stopped = F.col("_free").isNull() | ((F.col("_cap").cast("double") / F.col("_w")) < F.col("_free.k"))
    target = F.when(stopped, F.col("_cap").cast("double")).otherwise(F.least(F.col("_cap").cast("double"), share))
    return t.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, targets: DataFrame, bits: int = BITS, levels: int = LEVELS) -> DataFrame:
    """Per source: ``epochs`` (whole passes) and ``below`` (hash threshold of
    the partial pass).  ``rows`` has ``source``, ``size`` and ``hash``."""
    span = levels * bits
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = targets.withColumn("epochs", epochs.cast("long")).select(
        "source", "source_size", "target", "epochs",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("below"))
    for level in range(levels):
        shift = span - bits * (level + 1)
        state = materialise(state, "mix-state")
        s = small(state.select(F.col("source").alias("_s"), "below"))
        here = rows.join(s, rows["source"].eqNullSafe(s["_s"])).select(
            rows["source"], "size", "hash", "below")
        if level:  # only what lies in the boundary bucket found so far
            up = shift + bits
            here = here.where(F.shiftright("hash", up) == F.shiftright("below", up))
        bucket = F.shiftright("hash", shift).bitwiseAND((1 << bits) - 1)
        hist = here.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("words"))
        run = F.sum("words").over(W.partitionBy("source").orderBy("b"))
        hist = hist.withColumn("upto", run).withColumnRenamed("source", "_s")
        # buckets that fit in the budget as a whole; the next one is refined
        fit = (state.join(hist, state["source"].eqNullSafe(hist["_s"]), "left")
               .groupBy(state["source"], "source_size", "target", "epochs", "budget", "below")
               .agg(F.coalesce(F.max(F.when(F.col("upto") <= F.col("budget"), F.col("upto"))),
                               F.lit(0)).alias("used"),
                    F.min(F.when(F.col("upto") > F.col("budget"), F.struct("b", "upto"))).alias("e")))
        edge = F.coalesce("e.b", F.lit((1 << bits) - 1))
        if level == levels - 1:  # one hash value is left: take it if that comes nearer
            nearer = F.col("e.upto") - F.col("budget") < F.col("budget") - F.col("used")
            edge = F.when(F.col("e").isNull() | nearer, edge + 1).otherwise(edge)
        state = fit.select(
            "source", "source_size", "target", "epochs",
            (F.col("budget") - F.col("used")).alias("budget"),
            (F.col("below") + F.shiftleft(edge.cast("long"), shift)).alias("below"))
    return materialise(state.select("source", "source_size", "target", "epochs", "below"), "mix-thresholds")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The narrow rows (id, source, size, hash), written once, the threshold
    of every source, and the repeated ids, if any."""
    rows = materialise(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), row_hash(id_col, text_col).alias("hash")), "mix-rows")
    twice = _repeated(rows)
    if twice is not None:
        again = _numbered(docs, twice, id_col).select(
            F.col(f"_row.`{id_col}`").alias("id"), F.col(f"_row.`{source_col}`").cast("string").alias("source"),
            word_count(F.col(f"_row.`{text_col}`")).alias("size"), "hash")
        once = rows.join(small(twice, BROADCAST_KEYS), F.col("id").eqNullSafe(F.col("_again")), "left_anti")
        rows = materialise(once.unionByName(again), "mix-rows")
    sizes = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    return rows, thresholds(rows, source_targets(sizes, weights, max_epochs)), twice


def _repeats() -> Column:
    return F.col("epochs") + (F.col("hash") < F.col("below")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``source_size``, ``target``
    (of its source) and ``taken`` (words the mix takes, repeats counted)."""
    rows, limits, _ = plan(docs, id_col, text_col, source_col, weights, max_epochs)
    limits = small(limits.withColumnRenamed("source", "_s"))
    out = rows.join(limits, rows["source"].eqNullSafe(limits["_s"]), "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * _repeats()).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed rows themselves: every row as often as the mix takes it,
    columns unchanged."""
    _, limits, twice = plan(docs, id_col, text_col, source_col, weights, max_epochs)
    limits = small(limits.select(F.col("source").alias("_s"), "epochs", "below"))
    names = docs.columns
    once = docs
    if twice is not None:
        once = docs.join(small(twice, BROADCAST_KEYS), F.col(id_col).eqNullSafe(F.col("_again")), "left_anti")
    t = once.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), row_hash(id_col, text_col).alias("hash"))
    if twice is not None:
        t = t.unionByName(_numbered(docs, twice, id_col))
    t = t.withColumn("_src", F.col(f"_row.`{source_col}`").cast("string"))
    t = t.join(limits, t["_src"].eqNullSafe(limits["_s"])).withColumn("_k", _repeats()).where("_k > 0")
    t = t.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))))
    return t.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
