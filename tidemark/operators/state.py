"""Keyed incremental state: upsert, accounting, due filter, fallback
imputation, change projection and load stamps.

The upsert is "last write wins per key".  It is an aggregation
(``max_by`` over a total order), not a window, so Spark combines rows
map-side before the shuffle: a key holding a third of all rows is reduced
to one row per input partition before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import text as T
from tidemark.functions.compute import literal_table


def latest_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` tuple.

    ``order_cols`` must make a total order within a key (add a sequence
    column to break ties)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    order = F.struct(*[F.col(c) for c in order_cols])
    return (df.groupBy(*keys).agg(F.max_by(packed, order).alias("_row"))
              .select(*keys, *[F.col("_row")[c].alias(c) for c in others]))


def upsert(state: DataFrame, batch: DataFrame, keys, order_cols,
           origin_col: str | None = "origin") -> DataFrame:
    """New state = latest row per key over state and batch.

    Ties on ``order_cols`` go to the batch (a later write replaces the
    stored one).  Applying the same batch twice gives the same state.
    """
    s = state.withColumn("_src", F.lit(0))
    b = batch.withColumn("_src", F.lit(1))
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    merged = latest_per_key(s.unionByName(b), keys, order_cols + ["_src"])
    if origin_col:
        merged = merged.withColumn(origin_col, F.when(F.col("_src") == 1, "batch").otherwise("state"))
    return merged.drop("_src")


def replace_keys(state: DataFrame, batch: DataFrame, keys, time_col: str) -> DataFrame:
    """New state in which the batch replaces the stored row of its keys
    whatever the stored time says (it may not even be a time); among rows of
    the same side the latest parsed time wins."""
    rows = (state.withColumn("_src", F.lit(0)).unionByName(batch.withColumn("_src", F.lit(1)))
                 .withColumn("_at", T.parse_time(time_col)))
    return latest_per_key(rows, keys, ["_src", "_at"]).drop("_src", "_at")


def upsert_accounting(state: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """One row: batch keys that replace a stored key (``updated``), batch keys
    that are new (``inserted``) and the key count after the upsert
    (``total``).  Counted over distinct keys."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    sk = state.select(*keys).distinct().withColumn("_in_state", F.lit(True))
    bk = batch.select(*keys).distinct().withColumn("_in_batch", F.lit(True))
    j = sk.join(bk, keys, "full_outer")
    return j.agg(
        F.count_if(F.col("_in_batch") & F.col("_in_state").isNotNull()).alias("updated"),
        F.count_if(F.col("_in_batch") & F.col("_in_state").isNull()).alias("inserted"),
        F.count(F.lit(1)).alias("total"),
    )


def due_keys(keys_df: DataFrame, last_seen: DataFrame, keys, last_col: str, as_of,
             interval_seconds: float, incremental: bool = True) -> DataFrame:
    """Which keys need a refresh.

    Due when incremental refresh is off, the key was never loaded, or
    ``as_of - last >= interval`` (inclusive).  ``reason`` is 'new', 'stale',
    'fresh' or 'forced'.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    j = keys_df.select(*keys).join(last_seen.select(*keys, last_col), keys, "left")
    age = T.seconds_between(F.col(last_col), as_of)
    reason = (F.when(F.lit(not incremental), "forced")
               .when(F.col(last_col).isNull(), "new")
               .when(age >= F.lit(interval_seconds), "stale")
               .otherwise("fresh"))
    return j.withColumn("reason", reason).withColumn("due", F.col("reason") != "fresh")


def cycle_counts(due: DataFrame) -> DataFrame:
    """One row of refresh-cycle counters from ``due_keys`` output.

    Every due key yields one record (fetched or fallback), and a skipped
    key counts as a success with no record, so ``succeeded`` = all keys
    and ``records`` = due keys."""
    return due.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if("due").alias("n_due"),
        F.count_if(~F.col("due")).alias("n_skipped"),
        F.count_if(F.col("reason") == "new").alias("n_new"),
    ).withColumns({"records": F.col("n_due"), "succeeded": F.col("n_keys")})


def fallback_rates_frame(spark) -> DataFrame:
    rows = [(b, t, r) for b, m in fixed.FALLBACK_RATES.items() for t, r in m.items()]
    return literal_table(spark, rows, "base string, target string, rate double")


def impute(df: DataFrame, value_col: str, ref: DataFrame, keys, ref_value_col: str,
           random_key, low: float = fixed.RANDOM_RATE_LOW, high: float = fixed.RANDOM_RATE_HIGH,
           out: str | None = None) -> DataFrame:
    """Missing or zero values are replaced by the reference value for the
    key, else by a reproducible pseudo-random value in [low, high) derived
    from ``random_key``; replaced rows get ``source='fallback'`` and
    ``is_fallback=true``.

    ``ref`` is a reference table keyed like ``df``; no broadcast is forced:
    a literal table (e.g. ``fallback_rates_frame``) has exact size
    statistics and is broadcast by Spark's size threshold, a large one is
    shuffle-joined.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = out or value_col
    j = df.join(ref.select(*keys, F.col(ref_value_col).alias("_ref")), keys, "left")
    v = F.nullif(F.col(value_col), F.lit(0.0))
    scale = 10 ** fixed.RANDOM_RATE_DECIMALS
    span = int(round((high - low) * scale))
    rnd = F.lit(low) + T.hash_unit(random_key, span) / F.lit(float(scale))
    filled = F.coalesce(v, F.col("_ref"), rnd)
    return (j.withColumn("is_fallback", v.isNull())
             .withColumn("source", F.when(v.isNull(), F.lit(fixed.FALLBACK_SOURCE)))
             .withColumn(out, filled)
             .drop("_ref"))


def project_change(df: DataFrame, map_col, key_col, as_of, value_out: str = "exchange_rate",
                   fallback_col: str | None = "is_fallback") -> DataFrame:
    """Change record: the key's value out of a nested map (NULL when the key
    is absent), ``is_fallback`` defaulting to false and the save stamp."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    k = F.col(key_col) if isinstance(key_col, str) else key_col
    has_fb = bool(fallback_col) and fallback_col in df.columns
    fb = F.coalesce(F.col(fallback_col), F.lit(False)) if has_fb else F.lit(False)
    rest = [c for c in df.columns if not (has_fb and c == fallback_col)
            and c not in (value_out, "update_time")]
    return df.select(*rest, F.try_element_at(m, k).alias(value_out),
                     T.time_text(as_of).alias("update_time"), fb.alias("is_fallback"))


def load_stamps(df: DataFrame, as_of) -> DataFrame:
    """``update_time`` and ``crawl_time`` = save time as 'yyyy-MM-dd HH:mm:ss'."""
    t = T.time_text(as_of)
    return df.withColumn("update_time", t).withColumn("crawl_time", t)
