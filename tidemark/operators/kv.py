"""Keyed order store: row keys, day partitions, prefix scans and version
retention.

A wide-column store keyed by row key is modelled as a table with a
``rowkey`` column.  Day-prefixed keys (``yyyyMMdd_<id>``) make one day a
contiguous key range, so a prefix scan becomes a range predicate on the
source timestamp that the Parquet reader can push down.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import text as T


def with_order_keys(orders: DataFrame, id_col: str = "o_orderkey",
                    date_col: str = "o_orderdate", plain_prefix: str = "order_") -> DataFrame:
    """Add ``partition_date`` (yyyyMMdd), the plain key ``order_<id>`` and the
    partition-prefixed key ``<yyyyMMdd>_<id>``."""
    return orders.withColumns({
        "partition_date": T.day_key(date_col),
        "plain_rowkey": F.concat(F.lit(plain_prefix), F.col(id_col).cast("string")),
        "rowkey": T.row_key(T.day_key(date_col), id_col),
    })


def status_counts(df: DataFrame, status_col: str = "status") -> DataFrame:
    """SELECT status, COUNT(*) AS count ... GROUP BY status."""
    return df.groupBy(F.col(status_col).alias("status")).agg(F.count(F.lit(1)).alias("count"))


def _day_range(prefix: str):
    """[start, end) timestamps covered by a yyyy / yyyyMM / yyyyMMdd prefix."""
    if len(prefix) == 8:
        start = _dt.datetime.strptime(prefix, "%Y%m%d")
        end = start + _dt.timedelta(days=1)
    elif len(prefix) == 6:
        start = _dt.datetime.strptime(prefix, "%Y%m")
        end = (start.replace(year=start.year + 1, month=1) if start.month == 12
               else start.replace(month=start.month + 1))
    elif len(prefix) == 4:
        start = _dt.datetime.strptime(prefix, "%Y")
        end = start.replace(year=start.year + 1)
    else:
        raise ValueError("prefix must be yyyy, yyyyMM or yyyyMMdd")
    return start, end


def day_prefix_filter(date_col: str, prefix: str):
    """Predicate equal to ``date_format(date_col,'yyyyMMdd') LIKE prefix || '%'``
    but written as a range on the raw column so it reaches the scan."""
    start, end = _day_range(prefix)
    c = F.col(date_col)
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz")
    return (c >= lo) & (c < hi)


def partition_scan(orders: DataFrame, day: str, n: int = 5,
                   date_col: str = "o_orderdate", id_col: str = "o_orderkey") -> DataFrame:
    """``WHERE partition_date = day ORDER BY key LIMIT n`` (preview of one
    day partition; the limit is the feature)."""
    keyed = with_order_keys(orders.where(day_prefix_filter(date_col, day)), id_col, date_col)
    return keyed.where(F.col("partition_date") == day).orderBy(id_col).limit(n)


def prefix_scan(orders: DataFrame, prefix: str, date_col: str = "o_orderdate",
                id_col: str = "o_orderkey") -> DataFrame:
    """All rows whose day-prefixed row key starts with ``prefix``."""
    keyed = with_order_keys(orders.where(day_prefix_filter(date_col, prefix)), id_col, date_col)
    return keyed.where(F.startswith(F.col("rowkey"), F.lit(prefix)))


def kv_view(kv: DataFrame, columns=("order_id", "create_time", "amount", "status"),
            partition_col: str | None = "partition_date") -> DataFrame:
    """Relational view of the key-value table: row key plus the mapped
    columns, all as strings (positional mapping ``:key, cf:<col>...``)."""
    cols = [F.col("rowkey").cast("string").alias("rowkey")]
    cols += [F.col(c).cast("string").alias(c) for c in columns]
    if partition_col:
        cols.append(F.col(partition_col).cast("string").alias(partition_col))
    return kv.select(*cols)


def key_ordered(df: DataFrame, key: str = "rowkey", partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by key so written files hold contiguous key
    ranges; readers then skip row groups by min/max on prefix scans."""
    rp = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    return rp.sortWithinPartitions(key)


def keep_versions(cells: DataFrame, key_cols, version_col: str,
                  n: int = fixed.KV_MAX_VERSIONS, tie_col: str | None = None) -> DataFrame:
    """Newest ``n`` versions per cell key, numbered 1..n (1 = newest).

    Spark limits each group to ``n`` rows before the shuffle, so a hot key
    ships at most ``n`` rows from each input partition.
    """
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    order = [F.col(version_col).desc()] + ([F.col(tie_col).desc()] if tie_col else [])
    w = Window.partitionBy(*key_cols).orderBy(*order)
    return cells.withColumn("version", F.row_number().over(w)).where(F.col("version") <= n)


POINT_KEYS = 256    # keys that are looked up as filters of the scan


def multi_get(store: DataFrame, keys: DataFrame, key: str = "rowkey", partition_col: str = "partition_date",
              key_day=None) -> DataFrame:
    """Rows of a key-ordered store for the keys of a table; absent keys give
    none, a key asked for twice gives its row once.

    Up to ``POINT_KEYS`` distinct keys are written as equality filters, which
    the files' key bounds and Bloom filters answer (row groups without any of
    them are not read).  More keys are joined; the days of their keys
    (``key_day``, an expression over the key, e.g. its first eight characters)
    prune the partitions where the join is made by a broadcast.
    """
    wanted = keys.select(F.col(key).cast("string").alias(key)).dropna().distinct()
    some = [r[0] for r in wanted.limit(POINT_KEYS + 1).collect()]
    if len(some) <= POINT_KEYS:
        hit = F.lit(False)
        for k in sorted(some):
            hit = F.col(key) == k if k == min(some) else hit | (F.col(key) == k)
        return store.where(hit)
    if key_day is None:
        return store.join(wanted, key, "left_semi")
    with_day = wanted.withColumn(partition_col, key_day.cast(store.schema[partition_col].dataType))
    return store.join(with_day, [partition_col, key], "left_semi")


def as_of(versions: DataFrame, lookups: DataFrame, key: str, version_col: str, at_col: str, tie_col: str,
          block_seconds: int = 86_400) -> DataFrame:
    """For each lookup (``key``, ``at_col`` and its other columns) the newest
    version of its cell not later than ``at_col``: the version's columns,
    null where there is none yet.  Versions of one time are ordered by
    ``tie_col``, the greatest counts.

    Versions and lookups are put in one order and the last version is carried
    along, so nothing is paired.  A cell's history is cut into blocks of
    ``block_seconds``, each sorted by itself, so that a hot cell is spread over
    many tasks; what goes before a block comes from the last versions of the
    earlier blocks, of which a cell has one each.
    """
    others = [c for c in versions.columns if c != key]
    asked = [c for c in lookups.columns if c != key]
    cell, block = F.col(key).alias("_k"), lambda t: F.floor(F.unix_timestamp(F.col(t).cast("timestamp")) / block_seconds)
    no_lookup = F.lit(None).cast(lookups.select(F.struct(*asked)).schema[0].dataType)
    v = versions.select(cell, F.col(version_col).alias("_t"), block(version_col).alias("_b"), F.lit(0).alias("_kind"),
                        F.col(tie_col).alias("_tie"), F.struct(*others).alias("_v"), no_lookup.alias("_q"))
    q = lookups.select(cell, F.col(at_col).alias("_t"), block(at_col).alias("_b"), F.lit(1).alias("_kind"),
                       F.lit(None).cast(versions.schema[tie_col].dataType).alias("_tie"),
                       F.lit(None).cast(v.schema["_v"].dataType).alias("_v"), F.struct(*asked).alias("_q"))
    rows = v.unionByName(q)
    per_block = rows.groupBy("_k", "_b").agg(F.max_by("_v", F.when(F.col("_kind") == 0, F.struct("_t", "_tie"))).alias("_last"))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select(F.col("_k").alias("_k2"), F.col("_b").alias("_b2"),
                              F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    inside = Window.partitionBy("_k", "_b").orderBy("_t", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("_seen", F.last("_v", ignorenulls=True).over(inside)).where("_kind = 1")
    found = seen.join(before, F.col("_k").eqNullSafe(F.col("_k2")) & F.col("_b").eqNullSafe(F.col("_b2")), "left")
    value = F.coalesce(F.col("_seen"), F.col("_before"))
    return found.select(F.col("_k").alias(key), *[F.col(f"_q.{c}").alias(c) for c in asked],
                        *[value[c].alias(c) for c in others])
