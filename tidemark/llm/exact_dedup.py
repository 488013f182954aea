"""Exact dedup by a 128-bit content hash, with the bytes compared inside
each group so that colliding texts are never merged.

Rows are grouped on narrow columns only (id and hash).  The hashes that
more than one row has are counted and, up to ``BROADCAST_KEYS`` of them,
broadcast, so that the texts of all other rows stay where they are read
(beyond that number the texts are shuffled by hash).  For those hashes
``groupBy(hash, text)`` collapses equal copies before the shuffle: a hot
group ships one text per input partition and no task gathers its rows.

Defined cases: a null text equals the empty text; ids that are null rank
below every other id, so a group of null ids only keeps one of its rows;
rows that repeat both id and text are copies like any others and, when
theirs is the staying id, exactly one of them stays in :func:`drop_copies`
(in :func:`duplicate_groups` each row with the staying id says ``kept``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_KEYS, materialise, small, whole_text


def hash128(text: Column) -> Column:
    """128-bit content hash of the UTF-8 bytes."""
    return F.unhex(F.md5(text))


def _stay(keep: str, col: str) -> Column:
    return (F.max if keep == "largest" else F.min)(col)


def _collided(docs: DataFrame, repeated: DataFrame, text_col: str,
              hash_of: Callable[[Column], Column]) -> DataFrame:
    """Hashes that cover more than one distinct text, by comparing bytes."""
    texts = docs.select(hash_of(whole_text(text_col)).alias("_h"),
                        whole_text(text_col).alias("_t"))
    texts = texts.join(small(repeated.select("_h"), BROADCAST_KEYS), "_h", "left_semi")
    return (texts.groupBy("_h", "_t").agg(F.lit(1).alias("_one"))
                 .groupBy("_h").agg(F.sum("_one").alias("_texts"))
                 .where("_texts > 1").select("_h"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest",
                     hash_of: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id`` (id of the row of its
    group that stays), ``group_size``, ``kept`` and ``text_sha256``.

    ``keep`` picks the smallest or the largest id.  ``hash_of`` is the
    grouping hash; any function is right, a weak one is only slower.
    """
    rows = materialise(
        docs.select(F.col(id_col).alias("_id"), hash_of(whole_text(text_col)).alias("_h"),
                    F.sha2(whole_text(text_col), 256).alias("_sha")), "exact-rows")
    repeated = materialise(
        rows.groupBy("_h").agg(F.count("*").alias("_n"), _stay(keep, "_id").alias("_keep"))
            .where("_n > 1"), "exact-groups")
    collided = materialise(_collided(docs, repeated, text_col, hash_of), "exact-collisions")
    # a group with one text is known by its hash alone
    plain = repeated.join(collided, "_h", "left_anti")
    out = rows.join(plain, "_h", "left")
    if not collided.isEmpty():
        out = out.join(collided, "_h", "left_anti").select("_id", "_sha", "_n", "_keep")
        clash = (docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_t"))
                     .withColumn("_h", hash_of(F.col("_t")))
                     .join(collided, "_h", "left_semi"))
        each = clash.groupBy("_t").agg(F.count("*").alias("_n"), _stay(keep, "_id").alias("_keep"))
        out = out.unionByName(clash.join(each, "_t").select(
            "_id", F.sha2("_t", 256).alias("_sha"), "_n", "_keep"))
    lone = F.col("_n").isNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(lone, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (lone | F.col("_id").eqNullSafe(F.col("_keep"))).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest",
                hash_of: Callable[[Column], Column] = hash128) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns unchanged."""
    rows = materialise(
        docs.select(F.col(id_col).alias("_id"), hash_of(whole_text(text_col)).alias("_h")),
        "exact-rows")
    # how often the staying id itself occurs tells whether it is repeated
    ids = rows.groupBy("_h", "_id").agg(F.count("*").alias("_c"))
    pick = F.max if keep == "largest" else F.min
    best = F.struct(F.col("_id").isNotNull().cast("int").alias("known") if keep == "largest"
                    else F.col("_id").isNull().cast("int").alias("known"), F.col("_id"), F.col("_c"))
    repeated = materialise(
        ids.groupBy("_h").agg(F.sum("_c").alias("_n"), pick(best).alias("_b"))
           .where("_n > 1").select("_h", F.col("_b._id").alias("_keep"), F.col("_b._c").alias("_c")),
        "exact-groups")
    collided = materialise(_collided(docs, repeated, text_col, hash_of), "exact-collisions")
    names = docs.columns
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                         F.col(id_col).alias("_id"), hash_of(whole_text(text_col)).alias("_h"))
    plain = repeated.join(collided, "_h", "left_anti")
    kept = (tagged.join(small(plain, BROADCAST_KEYS), "_h", "left")
                  .where(F.col("_c").isNull() | F.col("_id").eqNullSafe(F.col("_keep"))))
    if not collided.isEmpty():
        clash = tagged.join(collided, "_h", "left_semi").withColumn("_t", whole_text(f"_row.{text_col}"))
        each = clash.groupBy("_t").agg(_stay(keep, "_id").alias("_keep"))
        some = clash.join(each, "_t").where(F.col("_id").eqNullSafe(F.col("_keep")))
        kept = (kept.join(collided, "_h", "left_anti").select("_row", "_id", "_h", "_c")
                    .unionByName(some.select("_row", "_id", "_h", F.lit(2).cast("long").alias("_c"))))
    if not collided.isEmpty() or not plain.where("_c > 1").isEmpty():
        # rows that repeat the staying id: one of each text remains
        again = kept.where("_c > 1").withColumn("_t", whole_text(f"_row.{text_col}"))
        kept = (kept.where("_c is null or _c = 1").select("_row")
                    .unionByName(again.dropDuplicates(["_id", "_t"]).select("_row")))
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
