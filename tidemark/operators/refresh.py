"""Refresh-cycle helpers: pair expansion, category derivation and lookup,
and the monitoring aggregates (conditional counts, coverage, freshness,
guarded success rate, log line count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import text as T


def expand_pairs(df: DataFrame, map_col: str, key_out: str = "base",
                 item_out: str = "target") -> DataFrame:
    """``map<k, array<v>>`` column -> one row per (k, v), other columns kept."""
    others = [c for c in df.columns if c != map_col]
    step = df.select(*others, F.explode(map_col).alias(key_out, "_items"))
    return step.select(*others, key_out, F.posexplode("_items").alias("item_pos", item_out))


def pairs_frame(spark, pairs: dict | None = None) -> DataFrame:
    """The fixed base -> targets dimension expanded to rows."""
    pairs = fixed.CURRENCY_PAIRS if pairs is None else pairs
    m = F.create_map(*[x for k, v in pairs.items()
                       for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))])
    return expand_pairs(spark.range(1).select(m.alias("pairs")), "pairs").drop("item_pos")


def region_of(c, groups: dict | None = None, default: str = fixed.DEFAULT_REGION):
    """Category from membership lists, first match wins, else default."""
    groups = fixed.REGION_PROVINCES if groups is None else groups
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for region, members in groups.items():
        cond = col.isin(*members)
        expr = F.when(cond, region) if expr is None else expr.when(cond, region)
    return expr.otherwise(default)


def temperature_text(region, ranges: dict | None = None,
                     default: tuple = fixed.DEFAULT_TEMP_RANGE):
    """'low-high' looked up by category, default when unknown."""
    ranges = fixed.TEMP_RANGES if ranges is None else ranges
    lows = F.create_map(*[x for k, v in ranges.items() for x in (F.lit(k), F.lit(v[0]))])
    highs = F.create_map(*[x for k, v in ranges.items() for x in (F.lit(k), F.lit(v[1]))])
    r = F.col(region) if isinstance(region, str) else region
    return F.concat(F.coalesce(F.try_element_at(lows, r), F.lit(default[0])), F.lit("-"),
                    F.coalesce(F.try_element_at(highs, r), F.lit(default[1])))


def fill_weather_defaults(df: DataFrame, as_of) -> DataFrame:
    """Weather rows whose fetch failed (all of weather/temperature/wind
    missing) get the fixed fallback record, ``source='fallback'`` and
    ``is_fallback=true``; the date is the day of ``as_of``."""
    failed = F.col("weather").isNull() & F.col("temperature").isNull() & F.col("wind").isNull()
    out = df.withColumn("is_fallback", failed)
    filled = {c: F.when(F.col("is_fallback"), F.lit(v)).otherwise(F.col(c))
              for c, v in fixed.WEATHER_FALLBACK.items()}
    filled["source"] = F.when(F.col("is_fallback"), F.lit(fixed.FALLBACK_SOURCE)).otherwise(F.col("source"))
    filled["date"] = F.coalesce(F.col("date"), T.time_text(as_of, fixed.DATE_TEXT_FORMAT))
    return out.withColumns(filled)


def state_stats(state: DataFrame, keys, time_col: str, fallback_col: str, as_of,
                interval_seconds: float, dimension_size=None, keys_unique: bool = False) -> DataFrame:
    """One row: total rows, distinct keys, fallback rows, fresh rows
    (``as_of - t <= interval``; unparsable/NULL time is not fresh) and the
    key coverage ratio against ``dimension_size`` (number or scalar Column).
    ``keys_unique`` says that the state has one row a key, so that no
    distinct count is needed."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    t = F.col(time_col)
    if dict(state.dtypes)[time_col] == "string":
        t = T.parse_time(t)
    age = T.seconds_between(t, as_of)
    aggs = [
        F.count(F.lit(1)).alias("total_records"),
        (F.count(F.struct(*keys)) if keys_unique else F.count_distinct(*[F.col(k) for k in keys])).alias("covered_keys"),
        F.count_if(F.coalesce(F.col(fallback_col), F.lit(False))).alias("fallback_records"),
        F.count_if(F.coalesce(age <= F.lit(interval_seconds), F.lit(False))).alias("fresh_records"),
    ]
    out = state.agg(*aggs)
    if dimension_size is not None:
        d = F.lit(dimension_size) if isinstance(dimension_size, (int, float)) else dimension_size
        out = out.withColumn("coverage", F.round(F.try_divide(F.col("covered_keys"), d), 4))
    return out


def coverage_sketches(df: DataFrame, group_cols, key, lg_k: int = 12) -> DataFrame:
    """One mergeable sketch (HyperLogLog) of the keys and the rows of each
    group, e.g. of a day; written once, it answers for any period without the
    rows."""
    return df.groupBy(*group_cols).agg(F.hll_sketch_agg(key, lg_k).alias("sketch"), F.count(F.lit(1)).alias("n_rows"))


def merged_coverage(sketches: DataFrame, period_cols) -> DataFrame:
    """Distinct keys (estimate) and rows of merged groups.  The relative
    standard error is about ``1.04 / sqrt(2 ** lg_k)``: 1.6 % for 12."""
    return sketches.groupBy(*period_cols).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("keys_estimate"),
                                              F.sum("n_rows").alias("n_rows"))


def success_rate(df: DataFrame, group_cols, failed) -> DataFrame:
    """Per group: total, failed and ``(total - failed) / total * 100``
    (rounded to 4 places; 0 when total is 0)."""
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    g = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("total"),
                                    F.count_if(failed).alias("failed"))
    rate = F.coalesce(F.try_divide((F.col("total") - F.col("failed")) * 100.0, F.col("total")),
                      F.lit(0.0))
    return g.withColumn("success_rate", F.round(rate, 4))


def count_non_blank_lines(df: DataFrame, text_col: str, group_cols=()) -> DataFrame:
    """Non-blank line count of a text column (per group): lines are split on
    newlines and a line of only whitespace does not count."""
    lines = df.select(*group_cols, F.explode(F.split(F.col(text_col), "\n")).alias("_line"))
    return (lines.where(T.strip_ws("_line") != "")
                 .groupBy(*group_cols).agg(F.count(F.lit(1)).alias("lines")))


def non_blank_lines(spark, path: str) -> DataFrame:
    """Number of non-blank lines of a text/JSONL log (one row)."""
    return (spark.read.text(path).where(T.strip_ws("value") != "")
                 .agg(F.count(F.lit(1)).alias("lines")))


RATE_STATE_SCHEMA = ("base_currency string, target_currency string, rates map<string,double>, "
                     "date string, timestamp string, source string, is_fallback boolean, "
                     "update_time string, crawl_time string")
RATE_SNAPSHOT_SCHEMA = "base_currency string, target_currency string, rate double"


def one_fetch_per_key(snapshot: DataFrame, keys, usable, time_col: str | None = None) -> DataFrame:
    """One landed fetch result a key: a usable one before a failed one, then
    the latest by ``time_col`` (where there is one), then the greatest values
    of the other columns in their order, so that the choice does not depend
    on how the rows are dealt out."""
    from tidemark.operators import state as S

    others = [c for c in snapshot.columns if c not in keys]
    rows = snapshot.withColumn("_usable", F.coalesce(usable, F.lit(False)))
    first = [time_col] if time_col in others else []
    order = ["_usable", *first, *[c for c in others if c not in first]]
    return S.latest_per_key(rows, keys, order).drop("_usable")


def refresh_rates(spark, state, snapshot, as_of, interval_seconds: float,
                  incremental: bool = True, pairs: dict | None = None) -> dict:
    """One refresh cycle of the pair-keyed rate state, as one batch plan.

    ``state``: current rows (base_currency, target_currency, rates map,
    date, timestamp, source, is_fallback, update_time, crawl_time).
    ``snapshot``: landed fetch results (base_currency, target_currency,
    rate, and optionally ``fetched_at``) - rate NULL or 0 when the fetch
    failed.  Of several results of a pair one counts
    (:func:`one_fetch_per_key`).

    Returns ``new_state`` (keyed upsert), ``changes`` (one change record
    per refreshed pair) and ``counts`` (cycle counters).
    """
    from tidemark.operators import state as S

    keys = ["base_currency", "target_currency"]
    dim = pairs_frame(spark, pairs).select(F.col("base").alias(keys[0]), F.col("target").alias(keys[1]))
    last = state.select(*keys, T.parse_time("update_time").alias("last_seen"))
    due = S.due_keys(dim, last, keys, "last_seen", as_of, interval_seconds, incremental)
    fetched = one_fetch_per_key(snapshot.select(*keys, "rate", *[c for c in ["fetched_at"] if c in snapshot.columns]),
                                keys, F.col("rate") != 0, "fetched_at")
    todo = due.where("due").select(*keys).join(fetched.select(*keys, "rate"), keys, "left")
    ref = S.fallback_rates_frame(spark).select(F.col("base").alias(keys[0]),
                                               F.col("target").alias(keys[1]), "rate")
    filled = S.impute(todo, "rate", ref.withColumnRenamed("rate", "ref_rate"), keys, "ref_rate",
                      random_key=F.concat_ws("_", *keys))
    # fetched rows carry no source / is_fallback (NULL: left out of JSON);
    # substituted rows are marked source='fallback', is_fallback=true
    rows = filled.select(
        *keys,
        F.create_map(F.col(keys[1]), F.col("rate")).alias("rates"),
        T.time_text(as_of, fixed.DATE_TEXT_FORMAT).alias("date"),
        T.time_text(as_of).alias("timestamp"),
        "source",
        F.when(F.col("is_fallback"), F.lit(True)).alias("is_fallback"))
    rows = S.load_stamps(rows, as_of)
    new_state = S.replace_keys(state.select(*rows.columns), rows, keys, "update_time")
    changes = S.project_change(rows, "rates", keys[1], as_of).select(
        *keys, "exchange_rate", "timestamp", "update_time", "is_fallback")
    counts = S.cycle_counts(due)
    return {"new_state": new_state, "changes": changes, "counts": counts, "due": due}


WEATHER_STATE_SCHEMA = ("province string, date string, weather string, temperature string, wind string, "
                        "source string, is_fallback boolean, update_time string, crawl_time string")
WEATHER_SNAPSHOT_SCHEMA = "province string, date string, weather string, temperature string, wind string, source string"


def provinces_frame(spark) -> DataFrame:
    """The fixed 34-province dimension."""
    from tidemark.functions.compute import literal_table
    return literal_table(spark, [(p,) for p in fixed.PROVINCES], "province string")


def refresh_weather(spark, state, snapshot, as_of, interval_seconds: float,
                    incremental: bool = True) -> dict:
    """One refresh cycle of the province-keyed weather state.

    Due provinces take their landed fetch result; a province whose fetch
    failed (no row, or no weather fields) gets the fixed fallback record.
    Returns ``new_state`` (keyed upsert), ``counts`` (cycle counters) and
    ``stats`` (coverage against the 34 provinces, fallback and fresh rows).
    """
    from tidemark.operators import state as S

    keys = ["province"]
    last = state.select("province", T.parse_time("update_time").alias("last_seen"))
    due = S.due_keys(provinces_frame(spark), last, keys, "last_seen", as_of, interval_seconds, incremental)
    snap = one_fetch_per_key(snapshot.select("province", "date", "weather", "temperature", "wind", "source"), keys,
                             F.coalesce("weather", "temperature", "wind").isNotNull(), "date")
    todo = due.where("due").select("province").join(snap, "province", "left")
    filled = fill_weather_defaults(todo, as_of)
    rows = filled.select("province", "date", "weather", "temperature", "wind", "source",
                         F.when(F.col("is_fallback"), F.lit(True)).alias("is_fallback"))
    rows = S.load_stamps(rows, as_of)
    new_state = S.replace_keys(state.select(*rows.columns), rows, keys, "update_time")
    stats = state_stats(new_state, keys, "update_time", "is_fallback", as_of, interval_seconds,
                        len(fixed.PROVINCES))
    return {"new_state": new_state, "counts": S.cycle_counts(due), "stats": stats, "due": due}


def unify_rate_states(*frames: DataFrame) -> DataFrame:
    """Rate-state rows written in either shape - nested ``rates`` map or flat
    ``exchange_rate`` - as one frame carrying both: the map form gets
    ``exchange_rate = rates[target]``, the flat form gets
    ``rates = {target: exchange_rate}``; other missing columns are NULL
    (union by name)."""
    out = None
    for df in frames:
        cols = set(df.columns)
        if "rates" in cols and "exchange_rate" not in cols:
            df = df.withColumn("exchange_rate", F.try_element_at("rates", F.col("target_currency")))
        elif "exchange_rate" in cols and "rates" not in cols:
            df = df.withColumn("rates", F.create_map(F.col("target_currency"), F.col("exchange_rate")))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def source_counts(state: DataFrame, source_col: str = "source") -> DataFrame:
    """One row: total records and the records per source ('api' /
    'fallback'), counted in one pass."""
    s = F.col(source_col)
    return state.agg(F.count(F.lit(1)).alias("total_records"),
                     F.count_if(s == "api").alias("api_records"),
                     F.count_if(s == fixed.FALLBACK_SOURCE).alias("fallback_records"))
