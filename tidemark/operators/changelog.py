"""Change-log operators: cursor reads, flattening, snapshot diff,
per-batch counters, lenient typing, defaults, retention and source merge.

All are DataFrame transformations; the stateless ones (flatten, lenient
typing, defaults, retention) work unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import jsonx
from tidemark.functions import text as T
from tidemark.functions.compute import with_computed
from tidemark.session import written

CHANGELOG_SCHEMA = ("change_id bigint, table_name string, record_id bigint, operation string, "
                    "old_data string, new_data string, change_time timestamp")


def after_cursor(df: DataFrame, cursor, id_col: str = "change_id", ordered: bool = True) -> DataFrame:
    """Rows with ``id > cursor`` (optionally ordered by id).

    ``cursor`` may be a number or a scalar Column (e.g. a scalar subquery
    from ``DataFrame.scalar()``).  A literal cursor is pushed to the scan.
    """
    cur = cursor if not isinstance(cursor, (int, float)) else F.lit(cursor)
    out = df.where(F.col(id_col) > cur)
    return out.orderBy(id_col) if ordered else out


def next_cursor(df: DataFrame, id_col: str = "change_id", previous: int = 0) -> DataFrame:
    """One row: the new cursor = max id seen (or the previous one)."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(previous)).alias("cursor"))


def flatten(changes: DataFrame, cdc_time=None, source_db: str = fixed.SOURCE_DB,
            out: str = "doc") -> DataFrame:
    """Add the flattened change document (see ``jsonx.flatten_change``)."""
    return with_computed(changes, out, jsonx.flatten_change(cdc_time=cdc_time, source_db=source_db))


def _malformed(c: str):
    """Non-blank JSON text that does not parse."""
    return (F.coalesce(F.col(c), F.lit("")) != "") & jsonx.json_value(c).isNull()


def malformed_changes(changes: DataFrame, old_data: str = "old_data", new_data: str = "new_data") -> DataFrame:
    """Change rows whose row image is non-blank but not valid JSON (to be
    kept aside in a quarantine table; the cursor still moves past them)."""
    return changes.where(_malformed(old_data) | _malformed(new_data))


def well_formed_changes(changes: DataFrame, old_data: str = "old_data", new_data: str = "new_data") -> DataFrame:
    return changes.where(~(_malformed(old_data) | _malformed(new_data)))


def with_envelope(changes: DataFrame, out: str = "envelope") -> DataFrame:
    return changes.withColumn(out, jsonx.change_envelope())


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, compare_cols=None) -> DataFrame:
    """Change rows between two snapshots keyed by ``key``.

    ``operation``: I (only in new), D (only in old), U (in both, some
    compared column differs, NULL-safe).  Unchanged rows are dropped.
    ``old_row`` / ``new_row`` carry the whole before and after rows, key
    included, whatever columns are compared.  One full outer join on the key; keys are unique per snapshot.
    """
    cols = compare_cols or [c for c in new.columns if c != key]
    o = old.select(F.col(key).alias("_k"), F.struct(*old.columns).alias("old_row"))
    n = new.select(F.col(key).alias("_k"), F.struct(*new.columns).alias("new_row"))
    j = o.join(n, "_k", "full_outer")
    compared = lambda row: F.struct(*[F.col(row)[c].alias(c) for c in cols])
    op = (F.when(F.col("old_row").isNull(), F.lit(fixed.OP_INSERT))
           .when(F.col("new_row").isNull(), F.lit(fixed.OP_DELETE))
           .when(~compared("old_row").eqNullSafe(compared("new_row")), F.lit(fixed.OP_UPDATE)))
    return (j.select(F.col("_k").alias(key), op.alias("operation"), "old_row", "new_row")
             .where(F.col("operation").isNotNull()))


def diff_to_changelog(diff: DataFrame, key: str, table_name: str, change_time, id_base=0) -> DataFrame:
    """Change-log rows (``CHANGELOG_SCHEMA``) from ``snapshot_diff`` output:
    I carries only the new image, D only the old one, U both, as JSON text.

    ``change_id`` = ``id_base`` + the row's number in the order of the key:
    dense, above every earlier id when ``id_base`` is the previous cursor,
    and the same when the job is repeated.  ``id_base`` may be a scalar
    Column.  The key must be numeric.
    """
    numbered = running_total(diff.withColumn("_one", F.lit(1).cast("bigint")), key, "_one", out="_number")
    base = F.lit(id_base) if isinstance(id_base, int) else id_base
    t = F.lit(change_time).cast("timestamp") if isinstance(change_time, str) else change_time.cast("timestamp")
    return numbered.select(
        (base + F.col("_number")).cast("bigint").alias("change_id"),
        F.lit(table_name).alias("table_name"),
        F.col(key).cast("bigint").alias("record_id"),
        F.col("operation"),
        F.when(F.col("operation") != fixed.OP_INSERT, F.to_json("old_row")).alias("old_data"),
        F.when(F.col("operation") != fixed.OP_DELETE, F.to_json("new_row")).alias("new_data"),
        t.alias("change_time"))


def apply_changelog(state: DataFrame | None, changes: DataFrame, row_schema: str,
                    key: str = "record_id") -> DataFrame:
    """State after a change log (``key``, ``change_id``, ``row``): of each
    record's changes the one with the greatest ``change_id`` counts; I and U
    put their new image, D leaves a tombstone (``row`` null), so that earlier
    changes that are applied once more do not bring the record back.
    ``state`` is an earlier result, or None.  Applying any of the same
    changes again changes nothing; :func:`current_rows` leaves the tombstones
    out."""
    new = changes.select(F.col("record_id").alias(key), "change_id",
                         F.when(F.col("operation") != fixed.OP_DELETE,
                                F.from_json("new_data", row_schema)).alias("row"))
    every = new if state is None else state.select(key, "change_id", "row").unionByName(new)
    return every.groupBy(key).agg(F.max("change_id").alias("change_id"),
                                  F.max_by("row", "change_id").alias("row"))


def current_rows(state: DataFrame) -> DataFrame:
    """The records of an :func:`apply_changelog` state that were not removed."""
    return state.where(F.col("row").isNotNull())


def _block_of(x, cuts: list, first: int = 0):
    """Number of ``cuts`` (sorted) below ``x``; searched by halves."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return (F.when(x > cuts[half], _block_of(x, cuts[half + 1:], first + half + 1))
             .otherwise(_block_of(x, cuts[:half], first)))


def running_total(df: DataFrame, order_col: str, value_col: str, out: str = "running_total",
                  block_rows: int = 1_000_000, most_blocks: int = 4096) -> DataFrame:
    """Cumulative sum of ``value_col`` in ``order_col`` order, without a
    window over all rows.

    The input is written once.  Quantiles of the order column, taken from
    the written table, cut it into blocks of about ``block_rows`` rows (at
    most ``most_blocks``, each then larger), however sparse or dense its
    values are; the block totals get their prefix sum (one row a block),
    which is joined back as the offset of a window in each block.
    ``order_col`` must be a numeric, unique ordering key.
    """
    df = written(df, "running-total")
    blocks = min(most_blocks, max(1, -(-df.count() // block_rows)))
    cuts = [] if blocks == 1 else df.agg(F.percentile_approx(
        order_col, [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0]
    with_b = df.withColumn("_blk", _block_of(F.col(order_col), sorted(set(cuts or []))))
    totals = with_b.groupBy("_blk").agg(F.sum(value_col).alias("_bt"))
    w_top = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_blk", F.coalesce(F.sum("_bt").over(w_top), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_blk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return (with_b.join(offsets, "_blk", "left")
                  .withColumn(out, F.col("_off") + F.sum(value_col).over(w))
                  .drop("_blk", "_off"))


def batch_metrics(changes: DataFrame, id_col: str = "change_id", batch_size: int = 1000,
                  batch_col: str | None = None) -> DataFrame:
    """Per-batch row count, last id and cumulative row count.

    Batches are ``id div batch_size`` unless an explicit ``batch_col`` is
    given (e.g. the micro-batch id of a stream).
    """
    bc = F.col(batch_col) if batch_col else F.expr(f"`{id_col}` div {int(batch_size)}")
    per = changes.groupBy(bc.cast("bigint").alias("batch_no")).agg(
        F.count(F.lit(1)).alias("batch_rows"), F.max(id_col).alias("last_id"))
    return running_total(per, "batch_no", "batch_rows", out="cumulative_rows")


def lenient_cast(df: DataFrame, casts: dict) -> DataFrame:
    """Type text columns without failing: bad values become NULL, rows kept.

    ``casts`` maps column -> Spark type name or ('timestamp', pattern).
    """
    out = df
    for c, t in casts.items():
        if isinstance(t, tuple) and t[0] == "timestamp":
            out = out.withColumn(c, T.parse_time(c, t[1]))
        else:
            out = out.withColumn(c, F.col(c).try_cast(t))
    return out


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill NULL columns with defaults (``DEFAULT`` clause on load);
    a missing column is created from its default."""
    out = df
    for c, v in defaults.items():
        dv = v if not isinstance(v, (str, int, float, bool)) else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), dv) if c in df.columns else dv)
    return out


def retention_filter(df: DataFrame, ts_col: str, as_of,
                     days_before: int = fixed.RETENTION_DAYS_BEFORE,
                     days_after: int = fixed.RETENTION_DAYS_AFTER) -> DataFrame:
    """Keep rows whose day lies in [as_of - before, as_of + after] days.

    Written as a range on the raw timestamp so it reaches the scan.
    """
    day0 = F.to_date(as_of if not isinstance(as_of, str) else F.lit(as_of))
    lo = F.date_sub(day0, days_before).cast("timestamp_ntz")
    hi = F.date_add(day0, days_after + 1).cast("timestamp_ntz")
    c = F.col(ts_col)
    return df.where((c >= lo) & (c < hi))


def merge_sources(frames: dict) -> DataFrame:
    """Union of several sources by column name, tagged with ``source_db``;
    columns missing in one source are NULL."""
    tagged = [df.withColumn("source_db", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
